"""Main text of web pages: a conditional random field over DOM leaf blocks."""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.blocks import Block, leaf_blocks
from parcelweave.llm.common import prepare
from parcelweave.llm.crf import Model, train

#: Labelled pages on which the model is trained.
TRAINING_PAGES = 500


def features(block: Block) -> list[str]:
    """Active features of a block: tags, names and parent above it, and the look of its text."""
    text = block.text
    words = text.count(" ") + 1
    out = ["bias", f"parent={block.parent}", f"words={min(words.bit_length(), 6)}", f"linked={int(block.linked * 3.99)}"]
    out += [f"tag={t}" for t in block.tags]
    out += [f"name={n}" for n in block.names]
    if text[-1] in ".!?…:;\"'»”)":
        out.append("ends")
    if "©" in text or "opyright" in text:
        out.append("rights")
    if block.place == 0:
        out.append("opens")
    return out


def labelled(page: str, main: Sequence[str]) -> tuple[list[list[str]], list[int]]:
    """Features and labels of a page whose main blocks have the given texts."""
    wanted, blocks = set(main), leaf_blocks(page)
    return [features(b) for b in blocks], [int(b.text in wanted) for b in blocks]


def fit(pages: Sequence[tuple[str, Sequence[str]]]) -> Model:
    """Train on pages given with the texts of their main blocks."""
    pairs = [x for x in (labelled(page, main) for page, main in pages) if x[0]]
    return train([p[0] for p in pairs], [p[1] for p in pairs])


@functools.cache
def default_model(pages: int = TRAINING_PAGES) -> Model:
    """The model trained on composed pages, whose labels are known by construction."""
    return fit(composed_pages(pages, seed=1))


def main_text(page: str | None, model: Model) -> str:
    blocks = leaf_blocks(page or "")
    return " ".join(b.text for b, mark in zip(blocks, model.decode([features(b) for b in blocks]), strict=True) if mark)


def extract(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", model: Model | None = None) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    The blocks that the model marks as main text, in page order, joined by one space.  Null and empty
    pages give an empty text; pages of any length and nesting are read whole, in one pass; null ids and
    urls are kept; repeated rows give repeated rows; an empty table gives no rows; further columns are
    left out.
    """
    spark = prepare(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(page.as_py(), shared.value) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    out = rows.mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


# Composed pages: parts of a page are drawn at random, each with its label.

_MAIN = ("article", "main", 'div class="content"', 'div id="content"', 'div class="post-content"', 'div class="entry-content"', 'div class="article-body"',
         'div class="story"', 'section role="main"', 'div class="post text"', 'div id="main"')
_NAV = ("nav", 'div class="menu"', 'div id="nav"', 'div class="navbar"', 'ul class="navigation"', 'div class="breadcrumbs"', 'div role="navigation"')
_HEAD = ("header", 'div id="header"', 'div class="masthead"', 'div class="site-header"', 'div class="top-bar"', 'div role="banner"')
_FOOT = ("footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"', 'div role="contentinfo"')
_SIDE = ("aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related-posts"', 'div class="recommended"', 'div role="complementary"',
         'div class="share social"', 'div class="tags"', 'div class="author-bio"')
_AD = ('div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"', 'div class="promo"', 'div id="banner"',
       'ins class="adsbygoogle"', 'div class="ad-slot"', 'div id="ad"')
_NOTE = ('div class="cookie-notice"', 'div id="cookies"', 'div class="cookie-banner"', 'div class="notice"', 'div class="consent"', 'div class="alert"', 'div class="popup modal"',
         'div class="newsletter subscribe"', 'div role="alert"', 'div role="dialog"', 'div class="gdpr"')
_TALK = ('section class="comments"', 'div id="comments"', 'div class="comment-list"', 'div class="reader-comments"', 'ol class="commentlist"', 'div id="disqus"',
         'div class="responses replies"', 'section id="comments"')


def composed_pages(count: int, seed: int) -> list[tuple[str, list[str]]]:
    """Labelled pages: HTML and the texts of the main blocks."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("abcdefghijklmnoprstuvwéü") for _ in range(rng.randint(1, 10)))

    def sentence(low: int = 2, high: int = 25) -> str:
        words = [word() for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + rng.choice("....!?")

    def prose() -> str:
        return " ".join(sentence() for _ in range(rng.choice((1, 1, 2, 4, 8)))) if rng.random() < 0.85 else sentence(1, 2)

    def label() -> str:
        return " ".join(word() for _ in range(rng.randint(1, 4)))

    def wrap(opening: str, inner: str) -> str:
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def links() -> str:
        items = "".join(f'<li><a href="/{word()}">{label()}</a></li>' for _ in range(rng.randint(2, 8)))
        return f"<ul>{items}</ul>" if rng.random() < 0.8 else " ".join(f'<a href="/{word()}">{label()}</a>' for _ in range(4))

    def loose() -> str:
        tag = rng.choice(("p", "p", "div", "span", "h3", "h2", ""))
        text = rng.choice((prose, label, prose))()
        return wrap(tag, text) if tag else text

    def form() -> str:
        return wrap(rng.choice(("form", 'form class="search"', 'form id="login"')), f"<label>{label()}</label><input name=q><button>{label()}</button>" + (f"<p>{prose()}</p>" if rng.random() < 0.4 else ""))

    def talk() -> str:
        items = "".join(
            rng.choice(("<li>{}</li>", '<div class="comment">{}</div>', "<article>{}</article>")).format(f"<b>{label()}</b><p>{prose()}</p>" + ("" if rng.random() < 0.6 else f"<p>{prose()}</p>"))
            for _ in range(rng.randint(1, 6))
        )
        return wrap(rng.choice(_TALK), (f"<h3>{label()}</h3>" if rng.random() < 0.6 else "") + items)

    def aside() -> str:
        return rng.choice(
            (
                lambda: wrap(rng.choice(_SIDE), f"<h3>{label()}</h3>" + rng.choice((links, loose))()),
                lambda: wrap(rng.choice(_AD), loose()),
                lambda: wrap(rng.choice(_NOTE), loose() + (f"<button>{label()}</button>" if rng.random() < 0.5 else "")),
                form,
                lambda: wrap(rng.choice(_NAV), links()),
            )
        )()

    def main() -> tuple[str, list[str]]:
        texts: list[str] = []

        def keep(text: str) -> str:
            texts.append(text)
            return text

        parts = [f"<h1>{keep(label() if rng.random() < 0.5 else sentence())}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.6:
                text = keep(prose())
                first, _, rest = text.partition(" ")
                shown = rng.choice((text, text, f"<b>{text}", f'<a href="/x">{first}</a> {rest}' if rest else text))
                parts.append(f"<p>{shown}" + rng.choice(("</p>", "</p>", "", "<br>")))
            elif kind < 0.7:
                parts.append(f"<h2>{keep(label())}</h2>")
            elif kind < 0.78:
                parts.append("<ul>" + "".join(f"<li>{keep(sentence())}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.84:
                parts.append(wrap(rng.choice(("blockquote", "pre", "div", "section")), f"<p>{keep(prose())}</p>"))
            elif kind < 0.88:
                parts.append("<table><tr>" + "".join(f"<td>{keep(label())}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.92:
                parts.append(f"<figure><img src=x><figcaption>{keep(sentence())}</figcaption></figure>")
            else:
                parts.append(rng.choice((aside, talk))())
        inner = "".join(parts)
        if rng.random() < 0.2:
            inner = wrap("div", inner)
        return wrap(rng.choice(_MAIN + ("article",) * 6), inner), texts

    out = []
    for _ in range(count):
        if rng.random() < 0.15:  # nothing but the text
            shown, texts = main()
            out.append((shown, texts))
            continue
        body = []
        if rng.random() < 0.6:
            body.append(wrap(rng.choice(_HEAD), f"<p>{label()}</p>" + (links() if rng.random() < 0.5 else "")))
        if rng.random() < 0.8:
            body.append(wrap(rng.choice(_NAV), links()))
        body += [aside() for _ in range(rng.choice((0, 1, 1, 2)))]
        if rng.random() < 0.97:
            shown, texts = main()
            body.append(shown)
        else:
            texts = []
        body += [aside() for _ in range(rng.choice((0, 1, 1, 2)))]
        if rng.random() < 0.4:
            body.append(talk())
        if rng.random() < 0.8:
            body.append(wrap(rng.choice(_FOOT), rng.choice((f"&copy; {label()} &middot; {sentence()}", f"<p>{prose()}</p>", links()))))
        out.append((f"<!DOCTYPE html><html><head><title>{label()}</title></head><body>{''.join(body)}</body></html>", texts))
    return out
