"""Language rules for text that mixes scripts, as column expressions. Flags in patterns make letters and cases those of all scripts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ARABIC, LATIN, blank, letters, share, stripped, without_markup

# Spanish function words, and words of the trade that a translation should not keep.
SPANISH_PHRASES = (
    "de la|del|de los|de las|para el|para la|sin |con el|con la|que el|que la|los |las |una |un |tu |su |muy |más |también|además|sobre|entre|hacia|desde|por el|por la|como "
)
SPANISH_TERMS = (
    "extracto|aceite|semilla|carbón|efecto|bloqueo|reactivación|calma|densidad|grosor|raíz|fortalecid[ao]|estimulación|frena|caída|mecánica|folicular|visible|inmediato|olor|ancla|"
    "miniaturización|ciclo|cabello|cabelludo|cuero|piel|champú|mascarilla|acondicionador|crema|suavizante|fortalecedor[a]?|nutritiv[oa]|reparador[a]?|protección|pérdida|cebolla|romero|"
    "salvia|dátil|fresa|nopal|aguacate|apio|levadura|oliva|uva|sésamo|argán|soja|vitamínic[oa]|crecimiento|capilar|enjuague|aplicación|resultado|beneficio|ingrediente|tratamiento|rutina|"
    "hidratante|revitalizante|ceramidas|ajo negro|negro|anticaída|limpieza profunda|exfoliante"
)
# Marks of Spanish whose number tells how likely it is.
SPANISH_MARKERS = (
    r"\bde\b", r"\bdel\b", r"\blos?\b", r"\blas?\b", r"\bcon\b", r"\bpara\b", r"\bpor\b", r"\bque\b", r"\buna?\b", r"\bes\b", r"\bcomo\b", r"\bmás\b", r"\btambién\b", r"\bnuestro\b", r"\bcabello\b",
    r"\bpiel\b", r"\baceit[ea]\b", r"\bcuero\b", r"\bcabeludo\b", r"\btratamiento\b", r"\bingredientes\b", r"\bdescripción\b", r"\bbeneficio\b", "[áéíóúñ¡¿]",
)
# Endings of Spanish words.
SPANISH_ENDINGS = "(?:ción|ante|ador|mente|miento|ular|ficante)"
# English terms that an Arabic text must not keep: of the whole shop, and of a shorter list that decides whether to translate again.
ENGLISH_TERMS = (
    r"shampoo|conditioner|serum|mask|scalp|hair\s*care|leave[\s-]*in|dry[\s-]*oil|clay[\s-]*mask|body\s*scrub|volumizing|thickening|hydrating|nourishing|revitalizing|exfoliating|replenishing|"
    r"purifying|nurturing|detoxifying|anti[\s-]*hair[\s-]*fall|age[\s-]*well|intensive\s+treatment|multivitamin|multivitamins|hair\s+density\s+system|hair\s+stimulation\s+system|"
    r"scalp\s*\+?\s*hair\s+revival|nurture\s+system|age[\s-]*well\s+system|description|benefits|ingredients|how\s+to\s+use|free\s+of|clinical\s+results|key\s+benefits"
)
REPEATED_TERMS = (
    r"Multivitamin|Shampoo|Conditioner|Serum|Mask|Routine|Scalp\s+Serum|Scalp\s+Shampoo|Scalp\s+Treatment|Hair\s+Fall|Hair\s+Loss|Hair\s+Growth|Hair\s+Care|Anti[- ]?Aging|Anti[- ]?Hair[- ]?Fall|"
    r"Well[- ]?Aging|Luxury\s+Sample|Discovery\s+Set"
)
# Beginnings of visible text that may stay in Latin script: numbers, short codes, signs, phone numbers, scientific terms.
LATIN_ALLOWED = (r"\d+", "[A-Z]{2,5}$", "©", "@", r"\+\d", "INCI", r"pH\s")
# Latin words that are names of substances rather than English.
KEPT_WORDS = ("ceramide", "inci", "nmf")
# Where a list of ingredients begins.
INGREDIENTS_HEADING = "(?:Full INCI|INCI الكامل)\\s*:"


def arabic_share(c: Column) -> Column:
    """Arabic letters of Arabic and Latin ones, 0 without either."""
    return F.coalesce(share(letters(c, ARABIC), letters(c, LATIN)), F.lit(0.0))


def is_visibly_arabic(c: Column, least: float = 0.4, allowed: tuple[str, ...] = ()) -> Column:
    """For what a page shows. Very short text, text without three letters, and what may stay in Latin script pass."""
    bare = stripped(F.coalesce(c, F.lit("")))
    arabic, latin = letters(bare, ARABIC), letters(bare, LATIN)
    excused = bare.rlike("^(?:" + "|".join((*LATIN_ALLOWED, *allowed)) + ")")
    return (F.length(bare) < 3) | excused | (arabic + latin < 3) | (latin == 0) | (arabic_share(bare) >= least)


def mixed_language(c: Column) -> Column:
    """Spanish or English, if over a quarter and over ten letters of an Arabic text are Latin and look it; else null."""
    arabic, latin = letters(c, ARABIC), letters(c, LATIN)
    mixed = (arabic > 0) & (latin > 10) & (latin / (arabic + latin) > 0.25)
    return F.when(mixed & c.rlike(rf"(?iuU){SPANISH_ENDINGS}\b"), "Spanish").when(mixed & c.rlike("[A-Z][a-z]+ [A-Z][a-z]+"), "English")


def spanish_hint(c: Column) -> Column:
    """likely_spanish with two markers, possibly_spanish with one in over 20 characters, else null."""
    found = sum((F.lower(c).rlike(f"(?uU){m}").cast("int") for m in SPANISH_MARKERS), F.lit(0))
    return F.when(F.length(c) < 3, None).when(found >= 2, "likely_spanish").when((found == 1) & (F.length(c) > 20), "possibly_spanish")


def _spanish_words(c: Column) -> Column:
    return c.rlike(rf"(?iuU)\b(?:{SPANISH_PHRASES})\b|\b(?:{SPANISH_TERMS})\b")


def is_spanish(c: Column, nodes: Column | None = None) -> Column:
    """Whether a text of four characters or more has a Spanish phrase or term. With nodes, the (path, value) array of a rich-text tree, a value that is one
    is judged by its texts of over five characters."""
    plain = F.coalesce((F.length(c) >= 4) & _spanish_words(c), F.lit(False))
    if nodes is None:
        return plain
    return F.when(c.startswith('{"type":') & (F.size(nodes) > 0), F.exists(nodes, lambda n: (F.length(n["value"]) > 5) & _spanish_words(n["value"]))).otherwise(plain)


def keeps_spanish(c: Column) -> Column:
    """Whether the Latin parts of an Arabic text, 15 characters or more together, are Spanish."""
    latin = F.array_join(F.regexp_extract_all(c, F.lit(rf"({LATIN}+(?:\s+{LATIN}+)*)"), 1), " ")
    return F.coalesce((F.length(latin) >= 15) & _spanish_words(latin), F.lit(False))


def needs_translation(c: Column, names: tuple[str, ...] = ()) -> Column:
    """Whether a text has English to translate: no number or measure, and two Latin letters in a row; a text that is mostly Arabic needs a
    word of three letters that is no name."""
    bare = stripped(F.coalesce(c, F.lit("")))
    number = bare.rlike(r"(?U)^[\d.,+%°×\-–—\s/\\:]+$") | bare.rlike(r"(?iU)^\d+\s*(?:mL|L|g|kg|oz|fl\.?\s*oz|cm|mm|m)\b")
    words = F.regexp_extract_all(bare, F.lit(r"(?U)\b([a-zA-Z]{3,})\b"), 1)
    real = F.exists(words, lambda w: ~F.lower(w).isin(*KEPT_WORDS, *names))
    enough = F.when(arabic_share(bare) > 0.7, real).otherwise(F.lit(True))
    return (F.length(bare) >= 2) & ~number & bare.rlike(f"{LATIN}{{2,}}") & enough


def english_terms(c: Column) -> Column:
    """English terms of the shop in a text, as they stand, markup aside."""
    return F.transform(F.regexp_extract_all(without_markup(F.coalesce(c, F.lit(""))), F.lit(rf"(?iU)\b((?:{ENGLISH_TERMS}))\b"), 1), F.trim)


def keeps_english(visible: Column) -> Column:
    """Whether an Arabic text keeps an English term, lists of ingredients aside."""
    before = F.get(F.split(visible, INGREDIENTS_HEADING, 2), F.lit(0))
    return F.coalesce(visible.rlike(r"[\x{0600}-\x{06FF}]") & before.rlike(rf"(?iU)\b(?:{REPEATED_TERMS})\b"), F.lit(False))


def _quoted(name: str) -> str:
    return r"\Q" + name + r"\E"


def names_replaced(c: Column, names: dict[str, str]) -> Column:
    """Names in any case replaced by their translations, longer ones first, so that a name within another is left to it. Translations must not hold names."""
    for name in sorted(names, key=lambda n: (-len(n), n)):
        c = F.regexp_replace(c, F.lit(f"(?iu){_quoted(name)}"), F.lit(names[name].replace("\\", r"\\").replace("$", r"\$")))
    return c


def names_left(c: Column, names: dict[str, str]) -> Column:
    """(name, translation) of each name that a text still has, in order, as it stands; the longest of several at one place."""
    pattern = "(?iu)(" + "|".join(_quoted(n) for n in sorted(names, key=lambda n: (-len(n), n))) + ")"
    lookup = F.create_map(*[F.lit(x) for n in {k.lower(): v for k, v in reversed(names.items())}.items() for x in n])
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), 1), lambda n: F.struct(n.alias("name"), F.element_at(lookup, F.lower(n)).alias("translation")))


def checkable_text(c: Column, rich_text: Column) -> Column:
    """Text for language checks: a rich-text tree's texts, else without tags. rich_text: of the tree, null if the value is none."""
    return F.when(blank(c), "").otherwise(F.coalesce(rich_text, F.regexp_replace(c, "<[^>]+>", " ")))
