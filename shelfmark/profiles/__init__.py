"""Seller profiles: per shop, what is a product page and which rules read it.

A profile is data plus column expressions. ``register_profile`` is the extension point;
the built-in profiles register themselves on import.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.flags import active_flag
from ..functions.text import slug_basic
from ..operators import html as H
from ..operators.derive import derived_fields
from ..schema import PRODUCT_DEFAULTS, template_row


@dataclass(frozen=True)
class Page:
    """Columns of one landed page; ``html`` is free of scripts and comments."""

    url: Column
    html: Column
    seller_name: Column
    base_url: Column

    def has(self, pattern: str) -> Column:
        return H.has(self.html, pattern)


class Found:
    """Cleaned readings of a page, by name."""

    def __init__(self, names: list[str], column: Column):
        self._at = {name: i for i, name in enumerate(names)}
        self._column = column

    def all(self, name: str) -> Column:
        return self._column[self._at[name]]

    def filled(self, name: str) -> Column:
        return F.filter(self.all(name), lambda v: v != "")

    def one(self, name: str) -> Column:
        return H.nth(self.all(name), 1)


Columns = dict[str, Column]


# Compared by identity, so that compiled rules can be kept per profile.
@dataclass(frozen=True, eq=False)
class Profile:
    name: str
    is_product: Callable[[Page], Column]
    # Raw strings read from the page and its blocks, as arrays.
    readings: Callable[[Page, Columns], Columns]
    # Product fields from the cleaned readings.
    rules: Callable[[Page, Found], Columns]
    # Opening-tag patterns of ``div`` elements whose inner HTML the readings need.
    blocks: dict[str, str] = field(default_factory=dict)
    # Hrefs to follow from a page; None for profiles that follow nothing.
    links: Callable[[Page], Column] | None = None
    # Links are followed only from pages that satisfy this.
    is_listing: Callable[[Page], Column] = lambda page: F.lit(True)
    drops_ignored_links: bool = True
    # False for shops whose links are followed whatever the recurse option says.
    honours_recurse: bool = True
    # Names whose slug is the lower-case name with hyphens.
    slugs: tuple[str, ...] = ()
    # True if blank slugs and flags are filled from other fields afterwards.
    derives: bool = False

    def rest_of_blocks(self, page: Page) -> Column:
        """What follows each block's opening tag, an array of strings."""
        return F.array(*[H.following(page.html, pattern) for pattern in self.blocks.values()]
                       ).cast("array<string>")

    def read(self, page: Page, blocks: Column) -> Columns:
        return self.readings(page, {name: blocks[i] for i, name in enumerate(self.blocks)})

    def product(self, page: Page, found: Found) -> Column:
        """The product row, a struct."""
        row = {"seller_product_url": page.url, "seller_name": page.seller_name,
               "base_url": page.base_url, **self.rules(page, found)}
        row.setdefault("seller_product_name", row["product_name"])
        for name in self.slugs:
            row[f"{name}_slug"] = slug_basic(row[f"{name}_name"])
        if self.derives:
            row |= derived_fields(lambda c: row.get(c, F.lit(PRODUCT_DEFAULTS.get(c, ""))))
        else:
            row["is_active"] = active_flag(row["in_stock"])
        return F.struct(*template_row(row))


_PROFILES: dict[str, Profile] = {}


def register_profile(profile: Profile) -> Profile:
    _PROFILES[profile.name] = profile
    return profile


def get_profile(name: str) -> Profile:
    if name not in _PROFILES:
        raise KeyError(f"no profile {name!r}; known: {sorted(_PROFILES)}")
    return _PROFILES[name]


def profile_names() -> list[str]:
    return sorted(_PROFILES)


from . import browser, sellers  # noqa: E402,F401  (register the built-in profiles)
