"""Schemas and the shop description."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import types as T

from vitrine import fixed

_TYPES = {"item_notes": T.ArrayType(T.StringType()), "images": T.ArrayType(T.StringType()), "map_price": T.DoubleType()}

PRODUCT_ROW = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in fixed.RAW_COLUMNS])

PAGES = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)

# flags and prices stay text: one odd value must not void the whole record
VARIATIONS = (
    "array<struct<variation_is_visible: variant, variation_is_active: variant, attributes: map<string,string>, "
    "display_price: string, image: struct<full_src: string, url: string, src: string>, sku: string>>"
)


@dataclass(frozen=True)
class Shop:
    """The shop whose pages are read."""

    base_url: str
    host_suffix: str = ""

    def __post_init__(self) -> None:
        object.__setattr__(self, "base_url", self.base_url.rstrip("/") + "/")
        if not self.host_suffix:
            object.__setattr__(self, "host_suffix", urlparse(self.base_url).netloc)
