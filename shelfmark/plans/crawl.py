"""One crawl round over landed pages: products, failures and the next URLs."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ..operators.extract import (
    dispatch, extract_all, failures_of, followed_urls, outcome_links, products_of,
)
from ..operators.links import difference, keep_domain
from ..session import cut


@dataclass(frozen=True)
class Round:
    products: DataFrame
    failures: DataFrame
    next_urls: DataFrame


def crawl_round(pages: DataFrame, visited: DataFrame, domain: str | Column,
                domains: dict[str, str] | None = None, recurse: bool = True) -> Round:
    """Pages are read once: products, failures and links, by the rules of each page's shop, are
    written together and split after. ``visited`` is ``(url)``."""
    outcomes = cut(extract_all(dispatch(pages, domains), recurse=recurse))
    found = keep_domain(followed_urls(outcome_links(outcomes, recurse=recurse)), domain)
    return Round(products_of(outcomes), failures_of(outcomes), difference(found, visited))
