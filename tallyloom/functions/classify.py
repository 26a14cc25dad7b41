"""Rules that sort fields, values and translations into classes, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import ARABIC, LATIN, blank, letters, share, stripped, without_markup

# How values begin that are addresses rather than text.
ADDRESSES = ("shopify://", "http://", "https://", "/", "gid://")
# Parts, endings and names of fields whose values are copied as they are.
KEPT_PARTS = (
    "facebook_url", "instagram_url", "tiktok_url", "twitter_url", "google_maps_api_key", "form_id", "portal_id", "region", "anchor_id", "worker_url",
    "default_lat", "default_lng", "custom_max_height", "custom_max_width", ".image_1:", ".image_2:", ".image_1_mobile:", ".image_2_mobile:", ".icon:",
)
KEPT_ENDINGS = (".link", "_url", ".image", ".image_1", ".image_2")
KEPT_NAMES = ("general.logo", "general.logo_inverse", "general.favicon")
# Patterns of field keys that hold no text.
SKIPPED_FIELDS = (
    r"\.image$", r"\.image_\d", r"\.icon:", r"\.link$", r"_url$", r"\.logo", r"\.favicon", "google_maps", "form_id", "portal_id", "anchor_id", "worker_url",
    "default_lat", "default_lng", "max_height", "max_width", "color_scheme", r"\.color$", r"\.colors$", "gradient", r"\.shadow_", "shadow_opacity", r"\.opacity$",
    "card_style", "badge_position", "crop_position", "section_width", "column_count", "row_count", "social_facebook$", "social_twitter$", "social_pinterest$",
    "social_instagram$", "social_tiktok$", "social_tumblr$", "social_snapchat$", "social_youtube$", "^handle$",
)
# Spellings of values that mean yes, no or nothing.
SWITCHES = ("true", "false", "yes", "no", "none", "null")

NUMBER, HEX = r"^-?\d+\.?\d*$", "^[0-9a-f]{8,}$"


def is_address(v: Column) -> Column:
    return _any(v.startswith(x) for x in ADDRESSES)


def _any(tests) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def is_reference_list(v: Column) -> Column:
    """A JSON array of nothing but global ids and digit strings; the empty array too. Numbers in it are no strings."""
    kind = F.schema_of_variant(F.try_parse_json(v))
    items = F.from_json(v, "array<string>")
    strings = (kind == "ARRAY<STRING>") & F.forall(items, lambda x: x.startswith("gid://") | x.rlike(r"^\d+$"))
    return F.coalesce(v.startswith("[") & v.endswith("]") & ((kind == "ARRAY<VOID>") & (F.size(items) == 0) | strings), F.lit(False))


def is_template(v: Column) -> Column:
    """Nothing but template expressions once tags are out."""
    bare = stripped(F.regexp_replace(v, "<[^>]+>", ""))
    return bare.rlike(r"^(\{\{[^}]+\}\}\s*[:;,]?\s*)+$")


def is_not_text(field: Column, value: Column) -> Column:
    """Rows that are never translated: blank, handles, addresses, numbers, hex ids, lists of references, templates, counters."""
    v = stripped(F.coalesce(value, F.lit("")))
    counter = v.startswith("{") & v.contains('"reviewCount"')
    return (v == "") | F.coalesce(field == "handle", F.lit(False)) | is_address(v) | v.rlike(NUMBER) | v.rlike(HEX) | is_reference_list(v) | is_template(v) | counter


def is_kept(field: Column) -> Column:
    """Fields whose value is copied unchanged."""
    return F.coalesce(_any([*(field.contains(x) for x in KEPT_PARTS), *(field.endswith(x) for x in KEPT_ENDINGS), field.isin(*KEPT_NAMES)]), F.lit(False))


def row_class(field: Column, value: Column, translated: Column) -> Column:
    """skip, keep, done or translate."""
    there = stripped(F.coalesce(translated, F.lit("")))
    done = (there != "") & (there != stripped(F.coalesce(value, F.lit(""))))
    return F.when(is_not_text(field, value), "skip").when(is_kept(field), "keep").when(done, "done").otherwise("translate")


def is_skipped_field(key: Column) -> Column:
    return F.coalesce(key.rlike("|".join(SKIPPED_FIELDS)), F.lit(False))


def is_skipped_value(value: Column) -> Column:
    """As is_not_text by value, with colours, switches and dimensions, without templates."""
    v = stripped(F.coalesce(value, F.lit("")))
    style = v.rlike("^#[0-9a-fA-F]{3,8}$") | v.rlike(r"^(?:rgba?|hsla?)\(") | v.rlike(r"^-?\d+\.?\d*(px|rem|em|vh|vw|%)$")
    counter = v.startswith("{") & v.contains('"reviewCount"')
    return (v == "") | is_address(v) | v.rlike(NUMBER) | v.rlike(HEX) | is_reference_list(v) | counter | style | F.lower(v).isin("true", "false")


def translation_status(source: Column, translated: Column, key: Column, outdated: Column, most_foreign: float = 0.3) -> Column:
    """SKIP, MISSING, IDENTICAL, OK, NOT_ARABIC, MIXED_LANGUAGE or OUTDATED, the first that holds, for plain values."""
    s, t = without_markup(source), without_markup(translated)
    own, foreign = letters(t, ARABIC), letters(t, LATIN)
    return (
        F.when(is_skipped_field(key) | is_skipped_value(source), "SKIP")
        .when(blank(translated), "MISSING")
        .when(s == "", "SKIP")
        .when((source == translated) & (own > 0), "OK")
        .when(source == translated, "IDENTICAL")
        .when(own + foreign == 0, "OK")
        .when(own == 0, "NOT_ARABIC")
        .when(foreign / (own + foreign) > most_foreign, "MIXED_LANGUAGE")
        .when(F.coalesce(outdated, F.lit(False)), "OUTDATED")
        .otherwise("OK")
    )


def is_truncated(source: Column, translated: Column) -> Column:
    """A translation of less than a fifth of a source of over 50 characters."""
    return (F.length(source) > 50) & (F.length(translated) < 0.2 * F.length(source))


# Further patterns of fields and values that the validation leaves out.
STYLE_FIELDS = (
    r"\.image(_\d(_mobile)?)?$", r"\.icon:", r"\.link$", r"_url$", r"\.logo", r"\.favicon", "google_maps", "form_id", "portal_id", "anchor_id", "worker_url", "default_la[tn]", "default_lng",
    "max_(height|width)", r"\.video(_url)?$", r"\.color(_|$)", "color_scheme", r"\.(opacity|padding|margin)$", "font_size", "border_radius",
)
STYLE_VALUES = ("^(shopify://|https?://|/|gid://)", r"^-?\d+\.?\d*$", "^#?[0-9a-fA-F]{3,}$", r"^\d+(\.\d+)?(px|rem|em|%|vh|vw|s|ms)$")
# Parts of field names that tell headings and bodies.
HEADING_PARTS = (".title", ".heading", ".label", ".name", "button_label", "button_text", "cta_text", ".tab_", ".menu_")
BODY_PARTS = (".body", ".description", ".content", ".rich_text", ".paragraph", ".details")
# Headings whose translation is short.
SHORT_HEADINGS = ("Key Benefits", "Key Ingredients", "How to Use", "How To Use", "Free Of", "Free of", "Fragrance")
# First parts of keys: of the platform, of a theme's own texts, and of either by where a key comes from.
PLATFORM_KEYS = ("shopify.", "customer_accounts.")
LOCALE_KEYS = ("accessibility.", "actions.", "blocks.", "blogs.", "contact.", "content.", "fields.", "gift_cards.", "placeholders.", "products.")
THEME_KEYS = (
    "accessibility.", "actions.", "blocks.", "blogs.", "cart.", "content.", "contact.", "collection.", "collections.", "date.", "filter.", "gift_cards.", "localization.", "newsletter.", "notifications.",
    "pagination.", "passwords.", "products.", "search.", "templates.",
)
# Words in names of image settings, endings that mean something else, and presets by type of section.
IMAGE_WORDS = ("image", "img", "background", "banner", "hero", "icon", "logo", "photo", "picture", "thumbnail", "video_poster")
NO_IMAGE_ENDINGS = ("_position", "_alignment", "_size", "_width", "_height", "_ratio")
SECTION_PRESETS = {
    "hero": "hero", "hero-section": "hero", "slideshow": "hero", "image-banner": "hero", "image-with-text": "hero", "collection-list": "collection", "featured-collection": "collection", "icon": "icon",
    "icons-with-text": "icon", "icon-row": "icon", "icon-row-with-heading": "icon", "logo-list": "logo", "multicolumn": "thumbnail", "video": "hero",
}
# Elements that are never closed.
VOID_TAGS = ("br", "hr", "img", "input", "meta", "link")


def _first(*rules: tuple[Column, str], otherwise: str | None = None) -> Column:
    out = F.lit(otherwise)
    for test, name in reversed(rules):
        out = F.when(test, name).otherwise(out)
    return out


def removal_reason(field: Column, value: Column) -> Column:
    """Why a row takes no part in validation: empty, field_pattern or untranslatable_value; null if it does."""
    v = stripped(F.coalesce(value, F.lit("")))
    style = v.rlike("(?i)<style>") & v.rlike("(?i)</style>") & (F.length(v) > 200) & (stripped(F.regexp_replace(F.regexp_replace(v, "(?is)<style>.*?</style>", ""), "<[^>]+>", " ")) == "")
    settings = v.startswith("{") & (v.contains('"reviewCount"') | v.contains('"formId"'))
    value_rule = F.lower(v).isin(*SWITCHES) | v.rlike("|".join(STYLE_VALUES)) | is_reference_list(v) | settings | style
    return _first((v == "", "empty"), (F.coalesce(field, F.lit("")).rlike("|".join(STYLE_FIELDS)), "field_pattern"), (value_rule, "untranslatable_value"))


def is_not_uploaded(field: Column, value: Column) -> Column:
    """As is_not_text without its rules for templates and counters: what an upload leaves out."""
    v = stripped(F.coalesce(value, F.lit("")))
    return (v == "") | F.coalesce(field == "handle", F.lit(False)) | is_address(v) | v.rlike(NUMBER) | v.rlike(HEX) | is_reference_list(v)


def has_arabic_for_upload(value: Column, rich_text: Column, least: float = 0.3) -> Column:
    """Like has_script, on a rich-text tree's texts where there are any, and without presentation forms."""
    arabic = r"[\x{0600}-\x{06FF}\x{0750}-\x{077F}\x{08A0}-\x{08FF}]"
    text = F.when(value.startswith("{") & value.contains('"type"') & (stripped(F.coalesce(rich_text, F.lit(""))) != ""), rich_text).otherwise(value)
    return F.when(blank(value), False).otherwise(F.coalesce(share(letters(without_markup(text), arabic), letters(without_markup(text), LATIN)) >= least, F.lit(True)))


def key_class(key: Column, value: Column) -> Column:
    """struct(category, reason) of a theme's key: shopify_platform, theme_locale, junk, useful or review, by the first rule that holds; keys before values."""
    v = stripped(F.coalesce(value, F.lit("")))
    bare = stripped(F.regexp_replace(v, "<[^>]+>", ""))
    # The patterns of junk and what each is called.
    junk = (
        (v == "", "empty value"),
        (v.startswith("shopify://shop_images/") | v.startswith("gid://"), "image/file reference"),
        (v.startswith("shopify://"), "Shopify internal link"),
        (bare.rlike(r"^(\{\{[^}]+\}\}\s*)+$"), "pure Liquid template"),
        (v.rlike(r"(?i)^\d+\s*(px|em|rem|vh|vw|%|fr|pt|cm|mm)$"), "CSS dimension"),
        (v.rlike(r"^(#[0-9a-fA-F]{3,8}$|rgba?\(\d)"), "color value"),
        (v.rlike(r"^[\d.,]+$"), "pure numeric"),
        (F.lower(v).isin("true", "false"), "boolean"),
        (v.rlike("^https?://"), "URL"),
        (v.rlike("^/(?:collections|products|pages|blogs|cart)/"), "internal path"),
        (v.startswith("{") & v.endswith("}"), "JSON blob"),
        (v.startswith("[") & v.endswith("]"), "JSON array"),
        (v.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), "UUID"),
        (v.rlike("^[A-Za-z0-9_-]{20,}$") & ~v.rlike("[a-z]{4,}"), "API key / technical ID"),
        (v.rlike(r"^[a-z]{2}\d$"), "region code"),
        (_any(key.contains(x) for x in ("anchor_id:", "form_id:", "portal_id:")), "form/anchor ID"),
        (_any(key.contains(x) for x in (".api_key:", ".worker_url:")), "API key setting"),
        (_any(key.contains(x) for x in ("default_lat:", "default_lng:")), "map coordinate"),
        (v.rlike(r"(?i)^[^\n]*\.(png|jpg|jpeg|svg|webp|gif|ico|mp4|webm)$"), "media filename"),
        (bare.rlike(r"^[\d.,+%°·×\-–—]+$"), "numeric/symbol in HTML"),
    )
    late = ((v.rlike(r"^[\d.,+%]+$"), "numeric display value"), (F.length(v) <= 2, "very short value"))
    rules = [
        (_any(key.startswith(x) for x in PLATFORM_KEYS), "shopify_platform", "Shopify platform string (checkout/accounts)"),
        (_any(key.startswith(x) for x in LOCALE_KEYS), "theme_locale", "theme locale string (covered by ar.json)"),
        *((test, "junk", why) for test, why in junk),
        (v.rlike("[a-zA-Z]{2,}"), "useful", "translatable text"),
        (v.rlike(r"[\x{0600}-\x{06FF}]{2,}"), "useful", "Arabic text"),
        *((test, "junk", why) for test, why in late),
    ]
    return F.struct(*[_first(*[(rule[0], rule[k]) for rule in rules], otherwise=last).alias(name) for k, name, last in ((1, "category", "review"), (2, "reason", "unclear"))])


def key_source(key: Column) -> Column:
    """Where a key comes from: theme_editor, theme_locale, checkout, shopify_system, customer_accounts, policy or other."""
    begins = lambda *parts: _any(key.startswith(p) for p in parts)
    return _first(
        (begins("section."), "theme_editor"), (begins("general."), "theme_locale"), (begins("shopify.checkout."), "checkout"), (begins("shopify."), "shopify_system"),
        (begins("customer_accounts."), "customer_accounts"), (begins(*THEME_KEYS), "theme_locale"), (F.lower(key).contains("policy"), "policy"), otherwise="other",
    )


def is_no_display_text(value: Column) -> Column:
    """References, addresses, colours, numbers, sizes, switches, JSON and names of media files."""
    v = stripped(value)
    # What is no text.
    patterns = (
        "^(shopify|gid|https?)://", "^/(?:collections|products|pages|blogs|cart)/", "^#[0-9a-fA-F]{3,8}$", r"^rgba?\(", r"^[\d.,]+$", r"(?i)^\d+\s*(px|em|rem|vh|vw|%|fr)$", "(?i)^(true|false)$",
        r"(?s)^(\{.*\}|\[.*\])$", r"(?i)^[^\n]*\.(png|jpg|jpeg|svg|webp|gif|mp4)$",
    )
    return _any(v.rlike(p) for p in patterns)


def content_kind(field: Column, text: Column) -> Column:
    """heading, body, ingredients or text."""
    name = F.lower(field)
    has = lambda parts: _any(name.contains(p) for p in parts)
    listed = F.coalesce(text, F.lit("")).rlike(r"^[A-Z][a-z]+(\s[A-Z][a-z]+)*(,\s*[A-Z])")
    return _first((has(HEADING_PARTS), "heading"), (has(BODY_PARTS), "body"), (listed, "ingredients"), otherwise="text")


def misplacement(source: Column, translated: Column, source_rich_text: Column) -> Column:
    """How a translation shows that it belongs elsewhere, or null. source_rich_text: texts of the source's tree, null if it is none."""
    s, t = stripped(F.coalesce(source, F.lit(""))), stripped(F.coalesce(translated, F.lit("")))
    tree = s.startswith("{") & s.contains('"type"')
    return F.when((s == "") | (t == ""), None).otherwise(_first(
        (t.startswith("{") & ~s.startswith("{") & t.contains('"type"'), "rich_text_json_in_plain_field"),
        (tree & ~t.startswith("{") & F.coalesce(F.length(source_rich_text) > 20, F.lit(False)) & (F.length(t) < 10), "truncated_json_translation"),
        (s.isin(*SHORT_HEADINGS) & (F.length(t) > 50), "heading_got_content_translation"),
        (t.contains('"reviewCount"') & ~s.contains('"reviewCount"'), "review_json_leaked"),
    ))


def script_issue(field: Column, source: Column, translated: Column, raw: Column) -> Column:
    """struct(reason, severity) of the first structural fault, or null. source, translated: visible texts; raw: the translated value as it is."""
    marked = lambda c: c.rlike("[™®©]") | c.rlike(r"^[A-Z][a-z]+\s*\(.*\)$")
    words = F.size(F.filter(F.split(source, r"(?U)\s+"), lambda w: w != ""))
    code = (words == 1) & (~source.rlike(r"^\p{Lu}") | (F.length(source) <= 3))
    same = (source == translated) & (F.length(source) > 2) & ~source.rlike(r"^\{\{.*\}\}$") & ~marked(source) & ~code
    arabic = letters(translated, ARABIC)
    ratio = F.coalesce(share(arabic, letters(translated, LATIN)), F.lit(0.0))
    none = (ratio == 0) & (F.length(translated) > 10) & ~marked(translated) & ~translated.rlike("^[A-Z][a-z]+ [A-Z][a-z]+")
    low = (ratio < 0.15) & (F.length(translated) > 50) & (arabic < 5)
    broken = stripped(raw).startswith("{") & raw.contains('"type"') & F.try_parse_json(raw).isNull()
    long, times = (F.length(source) > 20) & (F.length(translated) > 20), F.length(translated) / F.length(source)
    heading = ~long & (content_kind(field, source) == "heading") & (words <= 4) & (F.length(translated) > 200)
    # Limits above and what each fault is called.
    rules = (
        (same, F.lit("untranslated: Arabic identical to English"), "high"),
        (none, F.lit("no Arabic script in translation"), "high"),
        (low, F.format_string("only %s%% Arabic chars in translation", F.bround(ratio * 100).cast("int").cast("string")), "medium"),
        (broken, F.lit("corrupted rich_text JSON (invalid JSON structure)"), "high"),
        (long & (times > 5), F.format_string("Arabic is %.1fx longer than English", times), "medium"),
        (long & (times < 0.1), F.format_string("Arabic is %.1fx shorter than English", times), "medium"),
        (heading, F.format_string("heading has paragraph-length translation (%d chars)", F.length(translated)), "medium"),
    )
    out = F.lit(None)
    for test, reason, severity in reversed(rules):
        out = F.when(test, F.struct(reason.alias("reason"), F.lit(severity).alias("severity"))).otherwise(out)
    return F.when(~blank(source) & ~blank(translated), out)


def html_issues(source: Column, translated: Column) -> Column:
    """Array of faults: another number of tags than the source has, and tags that are opened and closed unequally often, by name."""
    tags = lambda c: F.regexp_count(c, F.lit("</?[a-zA-Z][^>]*>"))
    opened, closed = (F.regexp_extract_all(translated, F.lit(p), 1) for p in ("<([a-zA-Z]+)", "</([a-zA-Z]+)"))
    number = lambda names, tag: F.size(F.filter(names, lambda x: x == tag))
    unequal = F.filter(F.array_sort(F.array_distinct(opened)), lambda tag: (number(opened, tag) != number(closed, tag)) & ~F.lower(tag).isin(*VOID_TAGS))
    count = F.when(tags(source) != tags(translated), F.array(F.format_string("tag count: %d -> %d", tags(source), tags(translated)))).otherwise(F.array().cast("array<string>"))
    return F.concat(count, F.transform(unequal, lambda tag: F.concat(F.lit("unclosed <"), tag, F.lit(">"))))


def is_translatable_field(key: Column, source: Column) -> Column:
    """Not blank, no handle, no global id."""
    return F.coalesce((stripped(source) != "") & (key != "handle") & ~source.startswith("gid://"), F.lit(False))


def is_untranslated(translated: Column, source: Column, translated_rich_text: Column, source_rich_text: Column) -> Column:
    """Equal to the source, cases aside, or a tree with equal texts."""
    t, s = stripped(translated), stripped(source)
    trees = t.startswith("{") & s.startswith("{") & (translated_rich_text == source_rich_text)
    return F.coalesce(~blank(translated) & ~blank(source) & ((t == s) | (F.lower(t) == F.lower(s)) | F.coalesce(trees, F.lit(False))), F.lit(False))


def translation_bucket(field: Column, source: Column, translated: Column, is_bad: Column, was_done: Column, overwrite: bool = False) -> Column:
    """What becomes of a row: skip_empty, skip, keep, from_previous, bad, from_csv or translate. is_bad: of its translation; was_done: in an earlier run."""
    s, t = (stripped(F.coalesce(c, F.lit(""))) for c in (source, translated))
    has = (t != "") & F.lit(not overwrite)
    return _first(
        (s == "", "skip_empty"), (is_not_text(field, source), "skip"), (is_kept(field), "keep"), (F.coalesce(was_done, F.lit(False)), "from_previous"),
        (has & F.coalesce(is_bad, F.lit(False)), "bad"), (has, "from_csv"), otherwise="translate",
    )


def is_image_setting(key: Column) -> Column:
    k = F.lower(key)
    return _any(k.contains(w) for w in IMAGE_WORDS) & ~_any(k.endswith(x) for x in NO_IMAGE_ENDINGS)


def image_preset(section: Column, key: Column) -> Column:
    """By the first pattern that the section's type holds, else by the setting's key."""
    s, k = F.lower(section), F.lower(key)
    own = [(s.contains(p), preset) for p, preset in SECTION_PRESETS.items()]
    return _first(*own, (k.contains("icon"), "icon"), (k.contains("logo"), "logo"), (k.contains("hero") | k.contains("banner"), "hero"), (k.contains("thumbnail"), "thumbnail"), otherwise="default")


def normal_json(value: Column) -> Column:
    """A JSON value written again without blanks, null if it is none. What follows a whole value is passed over."""
    return F.to_json(F.try_parse_json(value))
