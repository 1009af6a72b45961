"""Text cleaning, URL rules and category names as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketflow.schema import CATEGORY_MAP, DEFAULT_CATEGORY

# White space that is stripped, and the patterns of URLs and ids.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"
AMAZON_ID_PATTERN = r"/dp/([A-Z0-9]{10})"
WALMART_ID_PATTERN = r"/ip/[^/]+/(\d+)"
NUMBER_PATTERN = rf"^[{WHITE_SPACE}]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[{WHITE_SPACE}]*$"
BASE_URLS = {"amazon": "https://www.amazon.com", "walmart": "https://www.walmart.com"}


def strip_ws(c: Column) -> Column:
    """Strip every kind of white space, not blanks only."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def number(c: Column) -> Column:
    """Plain decimal text, in white space or not, to double; NULL for anything else. The text is evaluated once."""
    return F.regexp_extract(c, NUMBER_PATTERN, 1).try_cast("double")


def clean_price(c: Column) -> Column:
    """Price text to double: drops dollar signs and commas; NULL when not a number."""
    return number(F.replace(F.replace(c, F.lit("$")), F.lit(",")))


def is_valid_url(c: Column) -> Column:
    """A scheme and a host must be there."""
    return F.coalesce(c.rlike(URL_PATTERN), F.lit(False))


def _first_group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def amazon_id(url: Column) -> Column:
    return _first_group(url, AMAZON_ID_PATTERN)


def walmart_id(url: Column) -> Column:
    return _first_group(url, WALMART_ID_PATTERN)


def product_id_from_url(retailer: Column, url: Column) -> Column:
    name = F.lower(retailer)
    return F.when(name == "amazon", amazon_id(url)).when(name == "walmart", walmart_id(url))


def product_url(retailer: Column, product_id: Column, product_name: Column) -> Column:
    name = F.lower(retailer)
    slug = F.replace(F.lower(product_name), F.lit(" "), F.lit("-"))
    return F.when(name == "amazon", F.concat(F.lit(BASE_URLS["amazon"] + "/dp/"), product_id)).when(
        name == "walmart", F.concat(F.lit(BASE_URLS["walmart"] + "/ip/"), slug, F.lit("/"), product_id)
    )


def normalize_category(retailer: Column, raw_category: Column) -> Column:
    """Retailer's category name to the index category; unknown names become 'other'."""
    pairs = chain.from_iterable(
        (F.lit(f"{r}\t{raw}"), F.lit(cpi)) for r, m in CATEGORY_MAP.items() for raw, cpi in m.items()
    )
    key = F.concat(F.lower(retailer), F.lit("\t"), F.lower(raw_category))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(DEFAULT_CATEGORY))


def percent_text(ratio: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", ratio * 100)
