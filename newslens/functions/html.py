"""Article extraction from HTML, as expressions over one page per row.

A page becomes an array of tokens, and one pass over its tags finds where each element
of interest starts and ends. Everything after that is a question about positions: which
text lies inside the first article and outside removed elements. No page is exploded or
shuffled, so a table of any size is extracted in the scan stage.
"""

from __future__ import annotations

from collections.abc import Callable
import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newslens.functions.text import BLANK, let, strip

# What is removed, where an article ends, how titles are cleaned.
UNWANTED_TAGS = ("aside", "nav", "footer")
UNWANTED_DIV_CLASS = "ad|ads|sponsored|promo|related|recommendation|footer"
UNWANTED_SECTION_CLASS = "related|recommendations"
HIDDEN_STYLE = r"display:\s?none"
END_MARKER = "End of Article"
TITLE_JUNK = rf"(?U)<[\s\S]*?>|[\t\r\f\x0B]|^[{BLANK}]+|[{BLANK}]+$"
RATIO_SKIPPED_TAGS = ("a", "noscript")
RATIO_UNSEEN_TAGS = ("img", "body", "html")
RATIO_TAGS_AND_BLANKS = r"</?\w++[^>]*+>|\s"

# What counts as an attribute for the text ratio: a name, "=", and all up to the last blank
# before the next "=", or up to ">". A match can only start where a name or the blanks
# before it start; saying so keeps the search linear in long texts without blanks.
RATIO_ATTRIBUTES = (
    r"(?:\G|(?<!\s))\s*+(?:\G|(?<![^=\s+]))[^=\s+]++\s*+=\s*([^=>]+)?(?=(\s+|>))"
)

# Fixed values of HTML: elements without content, and end tags that may be left out. An
# opening tag on the left closes an open element of the second column, but looks no
# further out than the elements of the third.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
)
CLOSES_PARAGRAPH = (
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir",
    "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hgroup", "main", "menu", "nav", "ol", "p", "pre",
    "section", "summary", "table", "ul",
)
CELL_TAGS = ("button", "object", "table", "td", "th")
TABLE_TAGS = ("table", "tbody", "tfoot", "thead", "tr", "td", "th")
BLOCK_TAGS = (*CLOSES_PARAGRAPH, "body", "dd", "dt", "html", "li", *TABLE_TAGS)
ITEM_SCOPE = tuple(
    t for t in (*BLOCK_TAGS, *CELL_TAGS) if t not in ("address", "dd", "div", "dt", "li", "p")
)
IMPLIED_END = {
    CLOSES_PARAGRAPH: (("p",), CELL_TAGS),
    ("li",): (("li", "p"), ITEM_SCOPE),
    ("dt", "dd"): (("dt", "dd", "p"), ITEM_SCOPE),
    ("td", "th"): (("td", "th"), ("tr", "table")),
    ("tr",): (("tr",), ("tbody", "thead", "tfoot", "table")),
    ("tbody", "thead", "tfoot"): (("tbody", "thead", "tfoot"), ("table",)),
    ("option",): (("option",), ("select",)),
}

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCKS = ("p", "div")
SPINE = ("article", *HEADINGS)
# Elements that stand for a missing article, in this order, by their class.
CLASSED = ("div", "section")
ARTICLE_CLASS = "article|content|main|story"
TRACKED = (*SPINE, *BLOCKS, *RATIO_SKIPPED_TAGS)

# A token: comment, raw-text element, declaration, tag (quotes respected where they
# balance), tag cut off by the end of the page, text, or a lone "<".
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style|title)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*>"
    r"""|</?[a-z][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
    r"|</?[a-z][^>]*>"
    r"|</?[a-z][^>]*\z"
    r"|[^<]+"
    r"|<"
)
TAG_NAME = r"^</?([a-zA-Z][a-zA-Z0-9:-]*)"
RAW_TAGS = ("script", "style", "title")
ENTITY = r"&(#[xX]0*[0-9a-fA-F]{1,6}|#0*[0-9]{1,7}|[a-zA-Z][a-zA-Z0-9]*);"
# Names of characters are spread over so many small tables.
ENTITY_SLOTS = 1024

# Stands for a tag between two texts; not a character HTML allows in text.
BREAK = "\x01"

OPEN, CLOSE, VOID, TEXT, RAW, COMMENT = "open", "close", "void", "text", "raw", "comment"


def tokens(html: Column) -> Column:
    """The page cut into ``array<struct<text, kind, tag>>``, nothing left out.

    ``kind`` is open, close, void, text, raw (script, style, title) or comment; ``tag`` is
    '' for texts and comments.
    """

    def token(text: Column) -> Column:
        def tagged(tag: Column) -> Column:
            return F.struct(
                text.alias("text"), tag_kind(text, tag).alias("kind"), tag.alias("tag")
            )

        plain = F.struct(
            text.alias("text"), F.lit(TEXT).alias("kind"), F.lit("").alias("tag")
        )
        name = F.lower(F.regexp_extract(text, TAG_NAME, 1))
        return F.when(text.startswith("<"), let(name, tagged)).otherwise(plain)

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), token)


def tag_kind(text: Column, tag: Column) -> Column:
    return (
        F.when(text.startswith("<!") | text.startswith("<?"), COMMENT)
        .when(tag == "", TEXT)
        .when(tag.isin(*RAW_TAGS) & ~text.startswith("</"), RAW)
        .when(~text.endswith(">"), COMMENT)
        .when(text.startswith("</"), CLOSE)
        .when(tag.isin(*VOID_TAGS) | text.endswith("/>"), VOID)
        .otherwise(OPEN)
    )


def attribute(text: Column, name: str) -> Column:
    """Raw value of an attribute of a tag, '' when absent."""
    value = F.regexp_extract(
        text, rf"""(?s)\s(?i:{name})\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1
    )
    return F.regexp_replace(value, """^["']|["']$""", "")


def is_removed(token: Column) -> Column:
    """The element this tag opens is navigation, advertising or hidden."""
    tag, text = token["tag"], token["text"]
    by_class = F.when(tag == "div", attribute(text, "class").rlike(UNWANTED_DIV_CLASS)).when(
        tag == "section", attribute(text, "class").rlike(UNWANTED_SECTION_CLASS)
    )
    return tag.isin(*UNWANTED_TAGS) | F.coalesce(by_class, F.lit(False)) | is_hidden(token)


def is_hidden(token: Column) -> Column:
    text = token["text"]
    return text.contains("display:") & attribute(text, "style").rlike(HIDDEN_STYLE)


def body_tokens(toks: Column) -> Column:
    """Tokens after the body tag. A page without one starts after its head, if any."""

    def position(tag: str, kind: str) -> Column:
        hit = F.transform(
            toks, lambda t, i: F.when((t["tag"] == tag) & (t["kind"] == kind), i)
        )
        return F.array_min(hit)

    start = F.coalesce(position("body", OPEN), position("head", CLOSE), F.lit(-1)) + 2
    return F.when(F.size(toks) > 0, F.slice(toks, start, F.size(toks)))


def has_content(body: Column) -> Column:
    """Whether the tokens hold any element or text at all."""
    visible = F.exists(
        body,
        lambda t: t["kind"].isin(OPEN, VOID) | ((t["kind"] == TEXT) & (strip(t["text"]) != "")),
    )
    return F.coalesce(visible, F.lit(False))


ELEMENT = "struct<tag:string,first:int,last:int,until:int,removed:boolean,skipped:boolean>"
OPEN_ELEMENT = "struct<tag:string,first:int,removed:boolean,gone:boolean,unseen:boolean>"


def elements(body: Column, tracked: tuple[str, ...] = TRACKED) -> Column:
    """Removed elements and those with a tracked tag, as an array of ``ELEMENT``.

    ``first`` is the position of the opening tag and ``last`` that of the tag that ends
    the element, its own end tag or one that implies it, or the token count when the page
    ends first. ``until`` is the position after the element: past its own end tag, but
    not past another's. A pass over the tags with a stack of open elements.

    Nothing inside a removed element is listed, so ``removed`` elements never overlap and
    come in page order. The same holds for ``skipped`` ones, which the text ratio leaves
    out.
    """
    closes = F.expr(_implied_end_map())

    def as_event(token: Column, i: Column) -> Column:
        opens = token["kind"] == OPEN
        return F.when(
            token["kind"].isin(OPEN, CLOSE),
            F.struct(
                i.alias("at"),
                opens.alias("opens"),
                token["tag"].alias("tag"),
                (opens & is_removed(token)).alias("removed"),
            ),
        )

    def cut_for(stack: Column, event: Column) -> Column:
        """Stack size that remains: elements above it end at this event."""
        implied = F.try_element_at(closes, event["tag"])

        def find(rule: Column) -> Column:
            def look(acc: Column, open_: Column) -> Column:
                depth = acc["depth"] + 1
                found = (
                    F.when(F.array_contains(rule["scope"], open_["tag"]), F.lit(0))
                    .when((acc["found"] == 0) & F.array_contains(rule["ends"], open_["tag"]), depth)
                    .otherwise(acc["found"])
                )
                return F.struct(depth.alias("depth"), found.alias("found"))

            start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("found"))
            return F.aggregate(stack, start, look, lambda acc: acc["found"])

        size = F.size(stack)
        found = F.when(
            event["opens"], F.when(implied.isNotNull(), let(implied, find)).otherwise(0)
        ).otherwise(
            F.when(F.get(stack, size - 1)["tag"] == event["tag"], size).otherwise(
                let(innermost(stack, event["tag"]), lambda own: reach(stack, own, event["tag"]))
            )
        )
        return let(found, lambda f: F.when(f > 0, f - 1).otherwise(size))

    def innermost(stack: Column, tag: Column) -> Column:
        """One-based position of the last open element of that name, 0 for none."""
        names = F.reverse(F.transform(stack, lambda open_: open_["tag"]))
        at = F.array_position(names, tag).cast("int")
        return F.when(at > 0, F.size(stack) - at + 1).otherwise(0)

    def reach(stack: Column, own: Column, tag: Column) -> Column:
        """0 where an end tag may not end what was opened in between: an inline one ends
        no block, and only a table's own tags end its cells."""
        between_ = F.slice(stack, own + 1, F.size(stack))
        stops = F.exists(
            between_,
            lambda e: (e["tag"].isin(*CELL_TAGS) & ~tag.isin(*TABLE_TAGS))
            | (e["tag"].isin(*BLOCK_TAGS) & ~tag.isin(*BLOCK_TAGS)),
        )
        return F.when((own > 0) & ~stops, own).otherwise(0)

    def ended(popped: Column, at: Column, end_tag: Column) -> Column:
        listed = F.filter(
            popped,
            lambda e: ~e["gone"]
            & (
                e["removed"]
                | (
                    e["tag"].isin(*tracked)
                    & ~(e["tag"].isin(*RATIO_SKIPPED_TAGS) & e["unseen"])
                )
            ),
        )
        return F.transform(
            listed,
            lambda e: F.struct(
                e["tag"].alias("tag"),
                e["first"].alias("first"),
                at.alias("last"),
                (at + F.when(e["tag"] == end_tag, 1).otherwise(0)).alias("until"),
                e["removed"].alias("removed"),
                (leaves_ratio(e) & ~e["unseen"]).alias("skipped"),
            ),
        )

    def leaves_ratio(e: Column) -> Column:
        return e["removed"] | e["tag"].isin(*RATIO_SKIPPED_TAGS)

    def step(state: Column, event: Column) -> Column:
        stack, done = state["stack"], state["done"]
        end_tag = F.when(~event["opens"], event["tag"])

        def after(kept: Column) -> Column:
            popped = F.slice(stack, kept + 1, F.size(stack))
            base = F.slice(stack, F.lit(1), kept)
            parent = F.get(base, kept - 1)
            opened = F.struct(
                event["tag"].alias("tag"),
                event["at"].alias("first"),
                event["removed"].alias("removed"),
                F.coalesce(parent["gone"] | parent["removed"], F.lit(False)).alias("gone"),
                F.coalesce(parent["unseen"] | leaves_ratio(parent), F.lit(False)).alias("unseen"),
            )
            return F.struct(
                F.when(event["opens"], F.concat(base, F.array(opened)))
                .otherwise(base)
                .alias("stack"),
                F.when(kept == F.size(stack), done)
                .otherwise(F.concat(done, ended(popped, event["at"], end_tag)))
                .alias("done"),
            )

        return let(cut_for(stack, event), after)

    start = F.struct(
        F.expr("array()").cast(f"array<{OPEN_ELEMENT}>").alias("stack"),
        F.expr("array()").cast(f"array<{ELEMENT}>").alias("done"),
    )

    def walk(toks: Column) -> Column:
        events = F.filter(F.transform(toks, as_event), lambda e: e.isNotNull())
        return F.aggregate(
            events,
            start,
            step,
            lambda s: F.concat(s["done"], ended(s["stack"], F.size(toks), F.lit(None))),
        )

    return let(body, walk)


def _implied_end_map() -> str:
    """``IMPLIED_END`` as a map literal from tag to struct(ends, scope)."""

    def array(names: tuple[str, ...]) -> str:
        return "array({})".format(", ".join(f"'{n}'" for n in names))

    entries = [
        f"'{name}', named_struct('ends', {array(ends)}, 'scope', {array(scope)})"
        for names, (ends, scope) in IMPLIED_END.items()
        for name in names
    ]
    return f"map({', '.join(entries)})"


def removed_ranges(els: Column) -> Column:
    return F.filter(els, lambda e: e["removed"])


def kept_elements(els: Column, tags: tuple[str, ...]) -> Column:
    """Elements with one of ``tags`` that are neither removed nor inside a removed one."""
    return F.filter(els, lambda e: e["tag"].isin(*tags) & ~e["removed"])


def first_article(els: Column) -> Column:
    """``struct(first, last)`` of the first article that is kept, null when none is."""
    spans = F.transform(
        kept_elements(els, ("article",)),
        lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")),
    )
    return F.array_min(spans)


def article_by_class(toks: Column, els: Column) -> Column:
    """The first article; without one the first kept div, without that the first kept section,
    whose class names an article. Null when there is none of them."""

    def first_of(tag: str) -> Column:
        named = F.filter(
            kept_elements(els, (tag,)),
            lambda e: attribute(F.get(toks, e["first"])["text"], "class").rlike(ARTICLE_CLASS),
        )
        return F.array_min(
            F.transform(named, lambda e: F.struct(e["first"].alias("first"), e["last"].alias("last")))
        )

    return F.coalesce(first_article(els), *[first_of(tag) for tag in CLASSED])


def shown_texts(toks: Column, els: Column) -> Column:
    """What each token shows: its text, a break for a tag, '' for a comment and for
    everything removed. Text on both sides of the latter runs together."""

    def show(token: Column) -> Column:
        return (
            F.when(token["kind"] == COMMENT, "")
            .when(token["kind"] == TEXT, token["text"])
            .otherwise(BREAK)
        )

    return blank_out(toks, removed_ranges(els), show)


def blank_out(toks: Column, left_out: Column, show: Callable[[Column], Column]) -> Column:
    """``show`` of every token, '' for those of the elements ``left_out``.

    Those do not overlap and come in order, so the tokens are taken gap by gap and each
    is looked at once.
    """
    nothing = F.expr("array()").cast("array<string>")

    def fill(ranges: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["until"]))
        ends = F.concat(F.transform(ranges, lambda r: r["first"]), F.array(F.size(toks)))
        gaps = F.zip_with(
            starts,
            ends,
            lambda s, e: F.when(
                e > s, F.transform(F.sequence(s, e - 1), lambda i: show(F.get(toks, i)))
            ).otherwise(nothing),
        )
        holes = F.concat(
            F.transform(ranges, lambda r: F.array_repeat(F.lit(""), r["until"] - r["first"])),
            F.array(nothing),
        )
        return F.flatten(F.flatten(F.zip_with(gaps, holes, lambda gap, hole: F.array(gap, hole))))

    return let(left_out, fill)


def glued(shown: Column, first: Column, last: Column) -> Column:
    """The shown tokens after position ``first`` and before position ``last``."""
    inner = F.transform(F.sequence(first + 1, last - 1), lambda i: F.get(shown, i))
    return F.when(last > first + 1, F.array_join(inner, "")).otherwise("")


def text_pieces(shown: Column, first: Column, last: Column) -> Column:
    """Text between two positions, one entry per run of text, entities decoded."""
    pieces = F.filter(F.split(glued(shown, first, last), BREAK), lambda t: t != "")
    return F.transform(pieces, decode_entities)


def join_text(pieces: Column) -> Column:
    """Pieces without outer blanks, blank ones dropped, joined by one space."""
    return F.array_join(F.filter(F.transform(pieces, strip), lambda t: t != ""), " ")


def marker_at(pieces: Column) -> Column:
    """Zero-based index of the piece holding the end marker, null when there is none."""
    return F.array_min(F.transform(pieces, lambda t, i: F.when(t.contains(END_MARKER), i)))


def readable_text(pieces: Column) -> Column:
    """Text up to the end marker. Before a marker, blanks between pieces are kept."""
    return let(
        pieces,
        lambda ps: let(
            marker_at(ps),
            lambda m: F.when(
                m.isNotNull(), strip(F.array_join(F.slice(ps, F.lit(1), m), " "))
            ).otherwise(join_text(ps)),
        ),
    )


def shown_markup(toks: Column, els: Column) -> Column:
    """The markup of each token as the text ratio sees it, '' for what it leaves out."""

    def show(token: Column) -> Column:
        dropped = token["kind"].isin(COMMENT, RAW) | token["tag"].isin(*RATIO_UNSEEN_TAGS)
        return F.when(dropped, "").otherwise(token["text"])

    return blank_out(toks, F.filter(els, lambda e: e["skipped"]), show)


def text_ratio(markup: Column) -> Column:
    """Share of characters that are neither tags nor blanks; 0 for nothing."""

    def share(bare: Column) -> Column:
        text = F.regexp_replace(bare, RATIO_TAGS_AND_BLANKS, "")
        return F.when(
            F.length(bare) > 0, F.length(text).cast("double") / F.length(bare)
        ).otherwise(F.lit(0.0))

    bare = F.when(markup.contains("="), F.regexp_replace(markup, RATIO_ATTRIBUTES, ""))
    return let(bare.otherwise(markup), share)


def text_blocks(markup: Column, els: Column) -> Column:
    """Every kept p and div with its text ratio, in page order.

    ``array<struct<first, last, tag, ratio>>``; the ratio counts the block's own pair of
    tags.
    """

    def measure(e: Column) -> Column:
        tag = e["tag"]
        own = F.concat(
            F.lit("<"), tag, F.lit(">"), glued(markup, e["first"], e["last"]),
            F.lit("</"), tag, F.lit(">"),
        )
        return F.struct(
            e["first"].alias("first"),
            e["last"].alias("last"),
            tag.alias("tag"),
            text_ratio(own).alias("ratio"),
        )

    return F.array_sort(F.transform(kept_elements(els, BLOCKS), measure))


def body_ratio(markup: Column) -> Column:
    return text_ratio(
        F.concat(F.lit("<body>"), F.array_join(markup, ""), F.lit("</body>"))
    )


def dense_blocks(markup: Column, els: Column, repeat_nested: bool = False) -> Column:
    """Blocks whose text ratio reaches that of the whole body.

    A block inside another chosen block is already part of it and is left out, unless
    ``repeat_nested`` asks for it again.
    """

    def choose(limit: Column) -> Column:
        chosen = F.filter(text_blocks(markup, els), lambda b: b["ratio"] >= limit)
        if repeat_nested:
            return chosen
        none = F.struct(
            F.lit(0).alias("until"),
            F.expr("array()").cast("array<struct<first:int,last:int,tag:string,ratio:double>>").alias("outer"),
        )

        def outermost(acc: Column, block: Column) -> Column:
            return F.when(block["first"] < acc["until"], acc).otherwise(
                F.struct(
                    block["last"].alias("until"),
                    F.concat(acc["outer"], F.array(block)).alias("outer"),
                )
            )

        return F.aggregate(chosen, none, outermost, lambda acc: acc["outer"])

    return let(body_ratio(markup), choose)


def article_spans(toks: Column, article: Column, repeat_nested: bool = False) -> Column:
    """Where the article text stands: ``array<struct<first, last>>``.

    The article element; without one the dense blocks; without those the whole body.
    """

    def span(first: Column, last: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"))

    def fallback(blocks: Column) -> Column:
        return F.when(
            F.size(blocks) > 0, F.transform(blocks, lambda b: span(b["first"], b["last"]))
        ).otherwise(F.array(span(F.lit(-1), F.size(toks))))

    def search(blocks: Column) -> Column:
        dense = let(
            shown_markup(toks, blocks), lambda markup: dense_blocks(markup, blocks, repeat_nested)
        )
        return let(dense, fallback)

    # Blocks and links are listed only here: a page with an article may hold very many.
    return F.when(article.isNotNull(), F.array(article)).otherwise(let(elements(toks), search))


def pieces_of(shown: Column, spans: Column) -> Column:
    return F.flatten(F.transform(spans, lambda s: text_pieces(shown, s["first"], s["last"])))


def heading_before(shown: Column, els: Column, position: Column) -> Column:
    """Text of the last heading that starts before ``position`` and has any text."""
    headings = F.filter(kept_elements(els, HEADINGS), lambda e: e["first"] < position)
    texts = F.transform(
        headings,
        lambda e: F.struct(
            e["first"].alias("first"),
            F.array_join(text_pieces(shown, e["first"], e["last"]), "").alias("text"),
        ),
    )
    return F.array_max(F.filter(texts, lambda t: t["text"] != ""))["text"]


def page_title(toks: Column) -> Column:
    """Text of the first title element, up to the first "_" and then the first "|"."""
    title = F.get(F.filter(toks, lambda t: (t["tag"] == "title") & (t["kind"] == RAW)), F.lit(0))
    inner = F.regexp_replace(title["text"], r"(?is)^<title\b[^>]*>|</title\s*>$", "")
    text = decode_entities(inner)
    head = F.split_part(text, F.lit("_"), F.lit(1))
    return F.coalesce(F.split_part(head, F.lit("|"), F.lit(1)), F.lit(""))


def clean_title(title: Column) -> Column:
    return F.regexp_replace(title, TITLE_JUNK, "")


def decode_entities(text: Column) -> Column:
    """Character references replaced by their characters, each exactly once."""
    slots = F.from_json(F.lit(_entity_json()), "array<map<string,string>>")

    def named(name: Column) -> Column:
        return F.try_element_at(F.get(slots, (F.crc32(name) % ENTITY_SLOTS).cast("int")), name)

    def code_point(number: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")

    def char(ref: Column) -> Column:
        hexa = F.regexp_extract(ref, r"^&#[xX]([0-9a-fA-F]+);$", 1)
        deci = F.regexp_extract(ref, r"^&#([0-9]+);$", 1)
        number = F.when(hexa != "", F.conv(hexa, 16, 10)).when(deci != "", deci).cast("bigint")
        return F.coalesce(
            F.when(
                number.isNotNull(),
                F.when(
                    (number > 0)
                    & (number <= 0x10FFFF)
                    & ~number.between(0xD800, 0xDFFF),
                    code_point(number),
                ).otherwise("�"),
            ),
            named(F.regexp_extract(ref, r"^&(\w+);$", 1)),
            ref,
        )

    def rebuild(t: Column) -> Column:
        texts = F.split(t, ENTITY)
        chars = F.transform(F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)), char)
        pairs = F.zip_with(texts, chars, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.array_join(pairs, "")

    return F.when(text.contains("&"), let(text, rebuild)).otherwise(text)


def _entity_json() -> str:
    """The names of characters, from the standard library's table, by slot."""
    slots: list[dict[str, str]] = [{} for _ in range(ENTITY_SLOTS)]
    for name, characters in html5.items():
        if name.endswith(";"):
            slots[zlib.crc32(name[:-1].encode()) % ENTITY_SLOTS][name[:-1]] = characters
    return json.dumps(slots)
