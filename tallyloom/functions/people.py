"""Names, phones and places of customers as column expressions. Blank means empty in the results."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import stripped

# States that stand for a province where the country is another one.
US_STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky",
    "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York",
    "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington",
    "West Virginia", "Wisconsin", "Wyoming",
)

_ARABIC = r"[\x{0600}-\x{06FF}]"


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def title_case(c: Column) -> Column:
    """First letters of runs of letters upper case, all others lower, also after apostrophes and hyphens."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def phone(c: Column, dialled: str = "00") -> Column:
    """Digits with one plus in front; under five characters none. dialled: digits that stand for the plus and go; without any all digits stay."""
    bare = F.regexp_replace(_or_empty(c), r"[^\d+]", "")
    number = F.when(bare.startswith(dialled), F.substring(bare, len(dialled) + 1, 1 << 30)).otherwise(bare) if dialled else bare
    return F.when(F.length(bare) < 5, "").otherwise(F.concat(F.when(bare.startswith("+"), "").otherwise("+"), number))


def split_name(c: Column) -> Column:
    """struct(first, last): up to the first white space and the rest."""
    name = stripped(_or_empty(c))
    parts = F.split(name, r"(?U)\s+", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("first"), _or_empty(F.get(parts, F.lit(1))).alias("last"))


def _one_case(c: Column) -> Column:
    return c.rlike(r"\p{L}") & ((F.upper(c) == c) | (F.lower(c) == c))


def name_case(c: Column) -> Column:
    """Names in one case get title case; Arabic and mixed ones stay, addresses are none."""
    return F.when(c.rlike(_ARABIC), c).when(c.contains("@"), "").when(_one_case(c), title_case(c)).otherwise(c)


def city_case(c: Column) -> Column:
    return F.when(~c.rlike(_ARABIC) & _one_case(c), title_case(c)).otherwise(c)


def name_of_email(c: Column) -> Column:
    """struct(first, last) of an address's parts of three letters or more."""
    parts = F.filter(F.split(F.substring_index(c, "@", 1), r"[._\-\d]+"), lambda p: p.rlike(r"^\p{L}{3,}$"))
    part = lambda k: F.when(c.contains("@"), _or_empty(title_case(F.get(parts, F.lit(k))))).otherwise("")
    return F.struct(_or_empty(part(0)).alias("first"), _or_empty(part(1)).alias("last"))


def province(c: Column, country: Column) -> Column:
    """Without a state of the United States for another country."""
    return F.when(_or_empty(c).isin(*US_STATES) & ~country.eqNullSafe("United States"), "").otherwise(_or_empty(c))


def address_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(_or_empty(c), "\n"), stripped), lambda x: x != "")


def city_candidates(c: Column) -> Column:
    """Spellings of a city to look up, the likeliest first: as it stands without marks, numbers and country; its part before a comma; its parts between slashes, and
    between hyphens from the last; its first word; what stands before a word for town."""
    text = F.replace(F.replace(F.translate(_or_empty(c), "\u00a0", " "), F.lit("&#039;"), F.lit("'")), F.lit("&amp;"), F.lit("&"))
    text = F.regexp_replace(F.regexp_replace(stripped(text), r"\s+\d{4,}.*$", ""), r"(?i)[,/]?\s*Saudi Arabia\s*$", "")
    text = stripped(F.regexp_replace(F.regexp_replace(text, r",?\s*\bSA\s*$", ""), r"[\x{200e}\x{200f}\x{202a}-\x{202e}]", ""))
    plain = stripped(F.regexp_replace(text, r"^\d+\s*/?\s*", ""))
    parts = lambda pattern: F.split(text, pattern)
    found = F.concat(
        F.array(text, F.substring_index(text, ",", 1)), parts("/"), F.reverse(parts(" - ")), F.when(text.contains(" - "), F.array().cast("array<string>")).otherwise(F.reverse(parts("-"))),
        F.array(plain, F.get(F.split(plain, r"\s+"), F.lit(0)), F.regexp_replace(plain, r"(?i) (industrial city|industrial|city|region).*$", "")),
    )
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.lower(stripped(x))), lambda x: x != ""))
