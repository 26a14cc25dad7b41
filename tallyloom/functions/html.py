"""HTML fragments cleaned of what a page builder leaves in them, in one pass of the standard parser over each, in Arrow batches."""

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements without content, and classes that a page builder adds.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BUILDER_CLASSES = (
    "pagebuilder-|product-items?|product-item-|widget-product-|price-container|price-final_price|price-wrapper|tocart|towishlist|tocompare|yotpo |bottomLine|bottomline-|columnGroup-root|column-root|"
    "post-blogPostContent|row-contained-|row-root-|row-full-width|text-root-|image-root-|image-img-|actions-primary|actions-secondary|product-image-container|product-image-wrapper|product-image-photo|"
    "block-with-products|productsCarousel|mage-|left-image|text-wrapper"
)

#: Elements that go with all they hold, elements that may stand for the one element within them, and attributes that go whatever they say: data and event handlers.
GONE, WRAPPERS = ("script", "style"), ("div", "span")
_gone_attribute = re.compile(r"data-.*|on[^\W\d_]+", re.DOTALL)
_builder = re.compile(BUILDER_CLASSES, re.IGNORECASE)
_link_within = re.compile(r"""href\s*=\s*(?:"#([^"]+)"|'#([^']+)'|#([^\s>]+))""", re.IGNORECASE)


class _Open:
    """An element that is being read: how its tag is written and what came within so far."""

    __slots__ = ("elements", "kept", "parts", "points", "tag", "text", "written")

    def __init__(self, tag: str, written: str, points: bool, kept: bool):
        self.tag, self.written, self.points, self.kept = tag, written, points, kept
        self.parts, self.elements, self.text = [], 0, False

    def closed(self) -> str:
        """The element as it goes on: nothing if it holds nothing and points nowhere; a bare wrapper of one element is that element."""
        within = "".join(self.parts)
        if not self.kept or not (self.parts or self.points):
            return ""
        if self.tag in WRAPPERS and self.written == f"<{self.tag}>" and self.elements == 1 and not self.text:
            return "".join(p for p in self.parts if not p.startswith("<!--") and p.strip())
        return f"{self.written}{within}</{self.tag}>"


class _Cleaner(HTMLParser):
    """Cleans in one pass: an element is written when it ends, from what its parts have become, so no tree is held.
    keep: for an attribute's name the parts of its value that stay; attributes without an entry stay whole."""

    def __init__(self, keep: dict):
        super().__init__(convert_charrefs=False)
        self.keep, self.open = keep, [_Open("", "", True, True)]

    def written(self, tag: str, attrs: list) -> tuple[str, bool]:
        told = {}
        for name, value in attrs:
            said = self.keep[name](value) if value and name in self.keep else value or ""
            if not _gone_attribute.fullmatch(name) and (said or not value):
                told[name] = said
        signs = "".join(f" {n}" if v == "" else ' {}="{}"'.format(n, v.replace("&", "&amp;").replace('"', "&quot;")) for n, v in told.items())
        return f"<{tag}{signs}>", bool(told.get("src") or told.get("href"))

    def part(self, text: str, element: bool = False, shown: bool = False) -> None:
        top = self.open[-1]
        top.elements += element
        top.text |= shown
        if text:
            top.parts.append(text)

    def end(self) -> None:
        done = self.open.pop()
        self.part(done.closed(), element=done.kept)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            self.part(self.written(tag, attrs)[0], element=True)
        else:
            self.open.append(_Open(tag, *self.written(tag, attrs), tag not in GONE))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.end()

    def handle_endtag(self, tag):
        if tag not in VOID and any(o.tag == tag for o in self.open[1:]):
            while self.open[-1].tag != tag:
                self.end()
            self.end()

    def handle_data(self, data):
        self.part(data, shown=bool(data.strip()))

    def handle_entityref(self, name):
        self.part(f"&{name};", shown=True)

    def handle_charref(self, name):
        self.part(f"&#{name};", shown=True)

    def handle_comment(self, data):
        self.part(f"<!--{data}-->")

    def whole(self, html: str) -> str:
        self.feed(html)
        self.close()
        while len(self.open) > 1:
            self.end()
        return "".join(self.open[0].parts)


def cleaned(html: str | None, classes=None, ids=None) -> str | None:
    """A fragment without scripts, styles, data and event attributes, foreign classes and ids, empty elements and mere wrappers. classes, ids: those that the theme
    has; without, only a page builder's classes go and ids stay, as do always ids that a link within the fragment points to."""
    if not html:
        return html
    own = {next(filter(None, found)) for found in _link_within.findall(html)}
    mine = (lambda c: not _builder.match(c)) if classes is None else classes.__contains__
    keep = {"class": lambda value: " ".join(filter(mine, value.split()))}
    if ids is not None:
        keep["id"] = lambda value: value if value in ids or value in own else ""
    text = re.sub(r"(?:&nbsp;\s*){3,}", " ", _Cleaner(keep).whole(html))
    return re.sub(" {2,}", " ", re.sub(r"\n{3,}", "\n\n", text)).strip()


@F.pandas_udf(T.StringType())
def clean_html(values: pd.Series) -> pd.Series:
    return values.map(cleaned)


def clean_html_of_theme(classes: set, ids: set):
    """As clean_html, keeping the classes and ids of a theme (see selectors)."""
    return F.pandas_udf(lambda values: values.map(lambda v: cleaned(v, classes, ids)), T.StringType())


def has_bloat(html: Column) -> Column:
    """Whether cleaning changes more than white space."""
    folded = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.coalesce((html != "") & (folded(html) != folded(clean_html(html))), F.lit(False))
