"""Joins between curated link pages and repositories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_link_targets(pages: DataFrame) -> DataFrame:
    """Distinct link targets of list pages: last path segment of every href,
    lower-cased, trailing punctuation removed."""
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("href"))
    target = F.lower(F.regexp_replace(F.regexp_extract("href", r"([^/]*)$", 1), r"[.,;:!?]+$", ""))
    return links.select(target.alias("target")).filter(F.col("target") != "").distinct()


def linked_from_pages(repos: DataFrame, pages: DataFrame, repo_key: str) -> DataFrame:
    """Repositories whose key appears as a link target on a list page (semi join)."""
    t = page_link_targets(pages)
    return repos.join(t, F.lower(repos[repo_key]) == t["target"], "left_semi")


# targets of HTML anchors and of Markdown links
HREF = r"""(?i)href\s*=\s*["']([^"']+)["']"""
MARKDOWN_LINK = r"\]\(([^)\s]+)"
# scheme (or none), www., host, port, owner, name; what follows the name is left out
REPOSITORY_URL = r"^(?:https?:)?//(?:www\.)?([^/:?#\s]+)(?::[0-9]+)?/+([^/?#\s]+)/+([^/?#\s]+)"


def repository_of(url: Column | str) -> Column:
    """(host, owner, name) of a repository's URL, in lower case: without scheme, www.,
    port, query, fragment, ``.git`` and any path below the repository.  Null when the URL
    names no owner and repository (relative links, profile pages, null)."""
    u = F.lower(F.trim(F.col(url) if isinstance(url, str) else url))
    part = lambda i: F.regexp_extract(u, REPOSITORY_URL, i)
    name = F.regexp_replace(part(3), r"\.git$", "")
    return F.when((part(1) != "") & (name != ""), F.struct(part(1).alias("host"), part(2).alias("owner"), name.alias("name")))


def listed_repositories(pages: DataFrame, text_col: str = "html") -> DataFrame:
    """Distinct (host, owner, name) of the repositories that curated lists link to, from
    HTML anchors and Markdown links; combined map-side, so a repository on every list
    is one row a task before the shuffle."""
    found = F.concat(F.regexp_extract_all(text_col, F.lit(HREF), 1), F.regexp_extract_all(text_col, F.lit(MARKDOWN_LINK), 1))
    links = pages.filter(F.col(text_col).isNotNull()).select(F.explode(found).alias("url"))
    return links.select(repository_of("url").alias("repository")).filter("repository is not null").select("repository.*").distinct()


def curated_repositories(repos: DataFrame, pages: DataFrame, url_col: str, text_col: str = "html") -> DataFrame:
    """Repositories that a curated list links to, by host, owner and name (semi join);
    columns of ``repos`` are kept as they are, rows whose URL names none go."""
    listed = listed_repositories(pages, text_col).select(F.struct("host", "owner", "name").alias("_listed"))
    return repos.join(listed, repository_of(repos[url_col]).eqNullSafe(listed["_listed"]), "left_semi")
