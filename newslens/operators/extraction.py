"""Pages to articles: each operator is a projection over (page_id, url, html)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import html as H
from newslens.functions.text import let


def tag_events(pages: DataFrame) -> DataFrame:
    """One row per token of each page: (page_id, pos, kind, tag, token)."""
    return pages.select(
        "page_id", F.posexplode(H.tokens(F.col("html"))).alias("pos", "t")
    ).select("page_id", "pos", "t.kind", "t.tag", F.col("t.text").alias("token"))


@lru_cache(maxsize=32)
def _kept(application: str, build: Callable[..., Column], *args) -> Column:
    """A column over ``html``, composed once per application.

    Composing one of these takes longer than extracting thousands of pages, and every
    micro-batch needs it again.
    """
    return build(*args)


def _column(pages: DataFrame, build: Callable[..., Column], *args) -> Column:
    return _kept(pages.sparkSession.sparkContext.applicationId, build, *args)


def _page() -> Column:
    return H.tokens(F.col("html"))


def _with_body(
    page: Column, use: Callable[[Column, Column], Column], tracked: tuple[str, ...] = H.SPINE
) -> Column:
    """``use(tokens, elements)`` of the body, each computed once."""
    body = let(page, H.body_tokens)
    return let(
        body, lambda toks: let(H.elements(toks, tracked), lambda els: use(toks, els))
    )


def _with_text(
    page: Column,
    use: Callable[[Column, Column, Column], Column],
    tracked: tuple[str, ...] = H.SPINE,
) -> Column:
    """``use(tokens, elements, shown texts)`` of the body, each computed once."""

    def shown(toks: Column, els: Column) -> Column:
        return let(H.shown_texts(toks, els), lambda texts: use(toks, els, texts))

    return _with_body(page, shown, tracked)


def _elements_column() -> Column:
    return _with_body(_page(), lambda toks, els: els, H.TRACKED)


def element_spans(pages: DataFrame) -> DataFrame:
    """One row per tracked element: (page_id, tag, first, last, until, ...)."""
    return pages.select("page_id", F.inline(_column(pages, _elements_column)))


def _clean_text_column() -> Column:
    return _with_text(
        _page(),
        lambda toks, els, shown: H.join_text(H.text_pieces(shown, F.lit(-1), F.size(toks))),
    )


def clean_text(pages: DataFrame) -> DataFrame:
    """Text of the whole body without removed elements."""
    text = _column(pages, _clean_text_column)
    return pages.select("page_id", F.coalesce(text, F.lit("")).alias("text"))


def _removed_column() -> Column:
    def count(gone: Column, toks: Column) -> Column:
        return F.struct(
            F.size(gone).alias("removed"),
            F.size(F.filter(gone, lambda e: H.is_hidden(F.get(toks, e["first"])))).alias("hidden"),
            F.aggregate(
                gone, F.lit(0), lambda n, e: n + e["until"] - e["first"]
            ).alias("tokens"),
        )

    return _with_body(
        _page(), lambda toks, els: let(H.removed_ranges(els), lambda gone: count(gone, toks))
    )


def removed_counts(pages: DataFrame) -> DataFrame:
    """Outermost removed elements per page, how many of them are hidden, and the tokens
    that go with them."""
    counts = pages.select("page_id", _column(pages, _removed_column).alias("c"))
    names = ("removed", "hidden", "tokens")
    return counts.select(
        "page_id", *[F.coalesce(f"c.{name}", F.lit(0)).alias(name) for name in names]
    )


def _article_column(repeat_nested: bool, by_class: bool) -> Column:
    """``struct(title, content)`` of a page, null without a body."""

    def extract(page: Column) -> Column:
        def from_body(toks: Column, els: Column, shown: Column) -> Column:
            def read(article: Column) -> Column:
                spans = H.article_spans(toks, article, repeat_nested)

                def finish(pieces: Column) -> Column:
                    # A heading counts only where the article still stands in its page:
                    # a rebuilt text has nothing before it.
                    in_place = article.isNotNull() & H.marker_at(pieces).isNull()
                    heading = F.when(in_place, H.heading_before(shown, els, article["first"]))
                    return F.struct(
                        H.clean_title(F.coalesce(heading, H.page_title(page))).alias("title"),
                        H.readable_text(pieces).alias("content"),
                    )

                return let(H.pieces_of(shown, spans), finish)

            article = H.article_by_class(toks, els) if by_class else H.first_article(els)
            return F.when(H.has_content(toks), let(article, read))

        return _with_text(page, from_body, (*H.SPINE, *H.CLASSED) if by_class else H.SPINE)

    return let(_page(), extract)


def articles(pages: DataFrame, repeat_nested: bool = False, by_class: bool = False) -> DataFrame:
    """Title and text of each page, the other columns kept; '' where there is none.

    ``by_class`` also takes a div or section for the article whose class says so, before the
    text ratio chooses.
    """
    nothing = F.struct(F.lit("").alias("title"), F.lit("").alias("content"))
    found = F.coalesce(_column(pages, _article_column, repeat_nested, by_class), nothing)
    # Generated rows: a filter on title or content stays above the extraction, where a
    # filter on a projected column would be pushed into it and extract a second time.
    return pages.select(
        *[c for c in pages.columns if c != "html"], F.inline(F.array(found))
    )


def _title_column() -> Column:
    return let(_page(), lambda toks: H.clean_title(H.page_title(toks)))


def with_title(pages: DataFrame) -> DataFrame:
    """Add ``title``, the cleaned title-element title."""
    return pages.withColumn("title", _column(pages, _title_column))


def titles(pages: DataFrame) -> DataFrame:
    return with_title(pages).select("page_id", "title")


def _blocks_column() -> Column:
    def rows(toks: Column, els: Column, shown: Column) -> Column:
        def measured(markup: Column) -> Column:
            return let(
                H.body_ratio(markup),
                lambda limit: F.transform(
                    H.text_blocks(markup, els), lambda b, i: row(b, i, limit, shown)
                ),
            )

        return let(H.shown_markup(toks, els), measured)

    def row(block: Column, i: Column, limit: Column, shown: Column) -> Column:
        return F.struct(
            (i + 1).alias("block"),
            block["tag"].alias("tag"),
            F.round(block["ratio"], 6).alias("ratio"),
            (block["ratio"] >= limit).alias("dense"),
            H.join_text(H.text_pieces(shown, block["first"], block["last"])).alias("text"),
        )

    return _with_text(_page(), rows, H.TRACKED)


def text_blocks(pages: DataFrame) -> DataFrame:
    """One row per kept p and div with its text ratio and the text it holds."""
    return pages.select("page_id", F.inline(_column(pages, _blocks_column)))


def _marker_column() -> Column:
    def count(toks: Column, els: Column, shown: Column) -> Column:
        def of(article: Column) -> Column:
            return let(
                H.text_pieces(shown, article["first"], article["last"]),
                lambda pieces: F.struct(
                    F.size(pieces).alias("pieces"),
                    F.coalesce(H.marker_at(pieces), F.size(pieces)).alias("kept"),
                ),
            )

        return let(H.first_article(els), lambda a: F.when(a.isNotNull(), of(a)))

    return _with_text(_page(), count)


def end_markers(pages: DataFrame) -> DataFrame:
    """Pieces of text in the first article, and how many are left after the end marker."""
    counts = pages.select("page_id", _column(pages, _marker_column).alias("c"))
    return counts.select(
        "page_id",
        F.coalesce("c.pieces", F.lit(0)).alias("pieces"),
        F.coalesce("c.kept", F.lit(0)).alias("kept"),
    )


def accepted(extracted: DataFrame) -> DataFrame:
    """Articles with both a title and a text."""
    return extracted.where((F.col("title") != "") & (F.col("content") != ""))


def rejected(extracted: DataFrame) -> DataFrame:
    """The others, kept for inspection."""
    complete = (F.col("title") != "") & (F.col("content") != "")
    return extracted.where(~F.coalesce(complete, F.lit(False)))
