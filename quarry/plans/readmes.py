"""README curation job and README-based examples.

Landed payloads (search hits, base64 README payloads, recursive trees) ->
selection -> top repositories per language -> joins -> decode -> gates ->
records + funnel.  Every step is a DataFrame transformation; the only window is
a top-k per language, bounded by the quota.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import alpaca
from ..operators import repos as R


@dataclass
class ReadmeResult:
    selected: DataFrame  # repositories returned by the search
    records: DataFrame  # every selected repo with decoded README and status
    scraped: DataFrame  # records that passed all gates
    funnel: DataFrame  # found / scraped / failed / filtered


def curate_readmes(hits: DataFrame, readmes: DataFrame, trees: DataFrame | None,
                   min_stars: int = K.SCRAPE_MIN_STARS, languages: list[str] = K.SCRAPE_LANGUAGES,
                   limit: int | None = K.SCRAPE_LIMIT, as_of: str = "2026-01-01",
                   with_timestamp: bool = True) -> ReadmeResult:
    selected = R.top_repos(R.select_repos(hits, min_stars, languages, as_of), limit, languages)
    joined = R.join_payloads(selected, readmes, trees, keep_missing_readme=True)
    records = R.repo_records(joined, with_timestamp=with_timestamp)
    return ReadmeResult(
        selected=selected,
        records=records,
        scraped=records.filter(F.col("status") == "scraped").drop("status"),
        funnel=R.funnel(records),
    )


def write_batch(scraped: DataFrame, root: str, batch: str) -> None:
    """Scraped records as JSON lines under ``batch=<timestamp>/``; a batch written again is replaced."""
    scraped.write.mode("overwrite").option("compression", "none").json(f"{root.rstrip('/')}/batch={batch}")


def readme_examples(scraped: DataFrame, contents: DataFrame, seed: int = K.DEFAULT_SEED) -> DataFrame:
    """README generation examples: repository context (structure and contents of the key
    files) -> README text."""
    df = R.with_key_files(scraped, contents).select(
        F.lit(None).cast("string").alias("instruction"),
        R.repo_context_prompt("repo_name", "file_tree", "key_files").alias("input"),
        F.col("readme").alias("output"),
        F.lit("github_readme").alias("source"),
        F.col("language").cast("string").alias("language"),
    )
    return alpaca._finish(df, "readme_gen", seed)
