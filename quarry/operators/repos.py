"""Repository payload operators: selection, decoding, trees, README gates, records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.quality import has_code_fence, readme_passes, readme_sections
from ..functions.text import col, let
from .ranking import top_k_per_group

BASE64_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/="


def decode_base64_text(content: Column | str) -> Column:
    """Lenient base64 -> UTF-8 text, null on any failure.

    Characters outside the base64 alphabet are dropped; decoding stops at the
    first padding that completes a quantum (later data is ignored); a dangling
    single character or incomplete padding fails; bytes must be valid UTF-8.
    """

    def body(s: Column) -> Column:
        p = F.instr(s, "=")
        d = F.when(p == 0, s).otherwise(F.substring(s, F.lit(1), p - 1))
        m = F.length(d) % 4
        ok = F.when(p == 0, m == 0).otherwise(
            (m == 0) | (m == 3) | ((m == 2) & (F.substring(s, p, F.lit(2)) == F.lit("=="))))
        raw = F.try_to_binary(F.concat(d, F.repeat(F.lit("="), (F.lit(4) - m) % 4)), F.lit("base64"))
        return F.when(ok, F.try_validate_utf8(raw.cast("string")))

    # what is left of the text without the alphabet goes: a negated class in a pattern
    # takes ten times as long on long texts
    foreign = lambda s: F.call_function("translate", s, F.lit(BASE64_CHARS), F.lit(""))
    return let(F.call_function("translate", col(content), foreign(col(content)), F.lit("")), body)


def path_depth(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def tree_within_depth(tree: Column | str, max_depth: int = K.TREE_MAX_DEPTH) -> Column:
    """Tree items whose path has at most ``max_depth`` slashes; missing size -> 0.
    A null tree stays null, an empty tree stays empty."""
    kept = F.filter(col(tree), lambda x: path_depth(x["path"]) <= max_depth)
    return F.transform(kept, lambda x: F.struct(
        x["path"].alias("path"), x["type"].alias("type"),
        F.coalesce(x["size"], F.lit(0).cast("bigint")).alias("size")))


def tree_text(tree: Column | str) -> Column:
    """Flat text of a tree: 'path:type:size' joined by '|' (for reports)."""
    return F.array_join(F.transform(col(tree), lambda x: F.concat_ws(
        ":", x["path"], x["type"], x["size"].cast("string"))), "|")


def key_files(tree: Column | str, names: list[str] = K.KEY_FILE_NAMES) -> Column:
    """Paths of manifest / entry-point files in a tree."""
    base = lambda x: F.regexp_extract(x["path"], r"([^/]+)$", 1)
    kept = F.filter(col(tree), lambda x: base(x).isin(names))
    return F.transform(kept, lambda x: x["path"])


def select_repos(hits: DataFrame, min_stars: int = K.SCRAPE_MIN_STARS,
                 languages: list[str] = K.SCRAPE_LANGUAGES, as_of: str = "2026-01-01",
                 within_days: int = K.SCRAPE_PUSHED_WITHIN_DAYS) -> DataFrame:
    """Stars >= min, language in the list, pushed after (as_of - within_days) by day."""
    cutoff = F.date_sub(F.to_date(F.lit(as_of)), within_days)
    return hits.filter(
        (F.col("stars") >= min_stars)
        & F.lower(F.col("language")).isin([x.lower() for x in languages])
        & (F.to_date(F.col("pushed_at")) > cutoff)
    )


def top_repos(selected: DataFrame, limit: int | None = K.SCRAPE_LIMIT,
              languages: list[str] = K.SCRAPE_LANGUAGES) -> DataFrame:
    """``limit // len(languages)`` repos per language (whatever its case) by stars
    (desc), then name.  A quota of 0 returns nothing; ``limit=None`` all repos."""
    if limit is None:
        return selected
    k = limit // max(len(languages), 1)
    keyed = selected.withColumn("_lang", F.lower("language"))
    return top_k_per_group(keyed, k, ["_lang"],
                           [F.col("stars").desc(), F.col("owner"), F.col("name")]).drop("_lang")


def join_payloads(repos: DataFrame, readmes: DataFrame, trees: DataFrame | None,
                  keep_missing_readme: bool = False) -> DataFrame:
    """repo JOIN readme LEFT JOIN tree.  A repo without a README payload is
    dropped, or kept with a null payload (``keep_missing_readme``) so that it
    can be counted as failed."""
    how = "left" if keep_missing_readme else "inner"
    out = repos.join(readmes.select("owner", "name", F.col("content").alias("readme_b64")), ["owner", "name"], how)
    if trees is not None:
        out = out.join(trees.select("owner", "name", "tree"), ["owner", "name"], "left")
    else:
        out = out.withColumn("tree", F.lit(None).cast("array<struct<path:string,type:string,size:bigint>>"))
    return out


def readme_status(readme: Column | str, min_chars: int = K.README_MIN_CHARS,
                  min_sections: int = K.README_MIN_SECTIONS) -> Column:
    """'failed' (missing or short README), 'filtered' (quality gate) or 'scraped'."""

    def body(r: Column) -> Column:
        present = r.isNotNull() & (F.length(r) >= min_chars)
        return (F.when(~F.coalesce(present, F.lit(False)), F.lit("failed"))
                .when(~readme_passes(r, min_sections), F.lit("filtered"))
                .otherwise(F.lit("scraped")))

    return let(col(readme), body)


def repo_records(joined: DataFrame, max_depth: int = K.TREE_MAX_DEPTH, with_timestamp: bool = True) -> DataFrame:
    """Repository record: repo_name, url, stars, language, description, readme,
    file_tree, scraped_at (+ status)."""
    readme = decode_base64_text("readme_b64")
    cols = [
        F.concat_ws("/", "owner", "name").alias("repo_name"),
        F.col("html_url").alias("url"),
        F.col("stars").cast("bigint").alias("stars"),
        F.col("language"),
        F.col("description"),
        F.col("pushed_at"),
        readme.alias("readme"),
        tree_within_depth("tree", max_depth).alias("file_tree"),
    ]
    if with_timestamp:
        cols.append(F.current_timestamp().alias("scraped_at"))
    out = joined.select(*cols)
    return out.withColumn("status", readme_status("readme"))


def readme_features(readme: Column | str) -> list[Column]:
    return [readme_sections(readme).alias("sections"), has_code_fence(readme).alias("has_code")]


def funnel(records: DataFrame) -> DataFrame:
    """found / scraped / failed / filtered as one row over all selected repos
    (a repo without a README payload has a null README and counts as failed)."""
    return records.agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(F.col("status") == "scraped").alias("scraped"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "filtered").alias("filtered"),
    )


def fence_language(path: Column) -> Column:
    """Language of a fence by the file's extension ('' without a known one)."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    expr = None
    for ext, lang in K.FENCE_LANGUAGES.items():
        expr = F.when(extension == ext, F.lit(lang)) if expr is None else expr.when(extension == ext, F.lit(lang))
    return expr.otherwise(F.lit(""))


def key_file_contents(records: DataFrame, contents: DataFrame, max_chars: int = K.KEY_FILE_CHARS,
                      max_files: int = K.KEY_FILE_LIMIT) -> DataFrame:
    """(repo_name, key_files): per repository the key files of its tree, by path, each
    with the first ``max_chars`` code points of its text.

    ``contents`` holds (owner, name, path, content in base64).  Tree and contents are joined by file,
    so a repository of many files is spread over tasks; of a repository's key files
    the ``max_files`` nearest its root (then by path) go into the prompt, which bounds the
    fold.  A file without contents, or whose contents do not decode, has a null text;
    contents of other files are not read further; a file given twice counts once (the
    greatest content); a repository without key files has no row.
    """
    keys = records.select("repo_name", F.explode(key_files("file_tree")).alias("path")).distinct()
    keys = top_k_per_group(keys, max_files, ["repo_name"], [path_depth(F.col("path")), F.col("path")])
    base = F.regexp_extract("path", r"([^/]+)$", 1)
    texts = (
        contents.filter(base.isin(K.KEY_FILE_NAMES))
        .groupBy(F.concat_ws("/", "owner", "name").alias("repo_name"), "path").agg(F.max("content").alias("content"))
        .select("repo_name", "path", F.left(decode_base64_text("content"), F.lit(max_chars)).alias("text"))
    )
    joined = keys.join(texts, ["repo_name", "path"], "left")
    return joined.groupBy("repo_name").agg(F.array_sort(F.collect_list(F.struct("path", "text"))).alias("key_files"))


def with_key_files(records: DataFrame, contents: DataFrame, max_chars: int = K.KEY_FILE_CHARS,
                   max_files: int = K.KEY_FILE_LIMIT) -> DataFrame:
    """Records with their ``key_files`` (null without any)."""
    return records.join(key_file_contents(records, contents, max_chars, max_files), "repo_name", "left")


def repo_context_prompt(repo_name: Column | str, tree: Column | str, files: Column | str) -> Column:
    """Repository prompt: project name, structure (sorted paths) and key files, each with
    its text in a fence (its path alone when the text is missing)."""
    paths = F.array_sort(F.transform(col(tree), lambda x: x["path"]))
    fenced = lambda x: F.concat(x["path"], F.lit(":\n```"), fence_language(x["path"]), F.lit("\n"), x["text"], F.lit("\n```,"))
    shown = F.transform(col(files), lambda x: F.coalesce(fenced(x), x["path"]))
    return F.concat(
        F.lit("Project: "), col(repo_name), F.lit("\n\nStructure:\n"),
        F.coalesce(F.array_join(paths, "\n"), F.lit("")),
        F.lit("\n\nKey Files:\n"), F.coalesce(F.array_join(shown, "\n\n"), F.lit("")),
    )
