"""Main text of web pages: a recurrent labeller of text blocks.

A page is a sequence of text blocks. Each block is a vector: its path of open
elements, hashed; its words, hashed; its length, share of linked text and place.
A bidirectional LSTM reads the sequence both ways and says of every block, in view of
the whole page, whether it is main text.

Pages carry no labels, so the network learns from plain signs of structure on a
bounded sample of pages: what stands in the element or under the name of an article is
text; what stands in navigation, headers, footers, sidebars, forms, notices, adverts
or comments is not. The sample is taken a second time with such parts added, made of
the page's own words, so that they are known even where the corpus has few.

Blocks keep the page's order; white space in a block is one space. Defined results: a
null or empty page, or one without main text, gives an empty text; repeated rows are
read each for itself; without any block to learn from every text is empty; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstrata.llm.common import shared
from clickstrata.llm.html_blocks import Block, blocks
from clickstrata.llm.lstm import Batch, BiLstm

PATH_WIDTH, WORD_WIDTH, HIDDEN = 96, 24, 16
# The bounded sample to learn from.
SAMPLE_PAGES, SAMPLE_CHARS = 250, 60_000
# Characters of pages labelled together.
AT_ONCE = 1 << 20

# Elements and names that mark what is no main text, and what is.
OTHER_TAGS = frozenset(
    "nav header footer aside form button menu dialog select fieldset head".split()
)
OTHER_NAMES = re.compile(
    r"^[.#=](.*[-_])?(ad|ads|adv|advert|advertisement|banner|breadcrumbs?|comments?|contentinfo|"
    r"consent|cookies?|disclaimer|footer|header|login|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|popup|promo|related|replies|reply|search|share|sidebar|social|sponsor|sponsored|"
    r"subscribe|toolbar|widget)s?([-_].*)?$"
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_NAMES = re.compile(r"^[.#=](.*[-_])?(article|content|entry|main|post|story|text)([-_].*)?$")


def looked_at(page: list[Block]) -> np.ndarray:
    """What the structure says of each block: 1 main text, 0 other."""
    other, inside = [], []
    for block in page:
        other.append(
            any(name in OTHER_TAGS or OTHER_NAMES.match(name) for name in block.path)
        )
        inside.append(any(name in MAIN_TAGS or MAIN_NAMES.match(name) for name in block.path))
    other, inside = np.array(other, bool), np.array(inside, bool)
    if (inside & ~other).any():
        return (inside & ~other).astype(float)
    long = np.array([len(b.clean) >= 80 and 3 * b.linked < len(b.text) for b in page], bool)
    return (long & ~other).astype(float)


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    vector = np.zeros(PATH_WIDTH)
    for depth, name in enumerate(reversed(path)):
        spot = zlib.crc32(name.encode())
        vector[spot % PATH_WIDTH] += 1.0 if spot >> 20 & 1 else -1.0
        if depth == 0:
            vector[zlib.crc32(b"last" + name.encode()) % PATH_WIDTH] += 1.0
    return vector


def vectors(page: list[Block]) -> np.ndarray:
    """A row of numbers for each block."""
    paths = {path: path_vector(path) for path in {block.path for block in page}}
    out = np.zeros((len(page), PATH_WIDTH + WORD_WIDTH + 6))
    for at, block in enumerate(page):
        row = out[at]
        row[:PATH_WIDTH] = paths[block.path]
        words = block.text.split()
        spots = np.bincount(
            [zlib.crc32(w.encode()) % WORD_WIDTH for w in words], minlength=WORD_WIDTH
        )
        row[PATH_WIDTH : PATH_WIDTH + WORD_WIDTH] = spots / len(words)
        chars = len(block.text)
        row[-6:] = (
            np.log1p(len(words)) / 4,
            min(1.0, block.linked / chars),
            sum(block.text.count(c) for c in ".,!?;") / len(words),
            at / len(page),
            1 / (1 + at),
            1 / (len(page) - at),
        )
    return out


def varied(page: str, number: int) -> str:
    """The page with parts added that are no main text, and its article under another name."""
    words = [w for block in blocks(page) for w in block.clean.split()] or ["text"]
    rng = np.random.default_rng(number)

    def some(n: int) -> str:
        start = int(rng.integers(0, max(1, len(words) - n)))
        text = " ".join(words[start : start + n])
        return text.replace("&", "&amp;").replace("<", "&lt;")

    top = (
        f"<header><h1>{some(4)}</h1><p>{some(12)}</p></header>"
        f'<div class="cookie-notice"><p>{some(25)}</p></div>'
    )
    low = (
        f'<aside class="sidebar"><h3>{some(3)}</h3><p>{some(20)}</p></aside>'
        f'<section id="comments"><div class="comment"><p>{some(30)}</p></div>'
        f'<div class="comment"><p>{some(45)}</p></div></section>'
        f"<form><label>{some(3)}</label><button>{some(2)}</button></form>"
    )
    names = ("<article>", "<main>", '<div class="content">', '<section class="post">')
    name = names[number % len(names)]
    tag = re.match(r"<(\w+)", name)[1]
    page = page.replace("<article>", name).replace("</article>", f"</{tag}>")
    page = re.sub(r"(<body[^>]*>)", lambda m: m[1] + top, page, count=1)
    if "<footer" in page:
        return page.replace("<footer", low + "<footer", 1)
    return page.replace("</body>", low + "</body>", 1)


def fit(pages: list[str]) -> BiLstm | None:
    sequences, labels = [], []
    for number, page in enumerate(pages):
        for form in (page, varied(page, number)):
            found = blocks(form)
            if found:
                sequences.append(vectors(found))
                labels.append(looked_at(found))
    if not sequences:
        return None
    network = BiLstm(PATH_WIDTH + WORD_WIDTH + 6, HIDDEN)
    network.fit(sequences, labels, rounds=max(8, min(200, 4000 // len(sequences))))
    return network


def train(pages: DataFrame) -> BiLstm | None:
    """Fit on a bounded sample of the different pages, drawn by their hashes.

    The hashes are drawn first, so that only the sample's pages leave the tasks.
    """
    html = F.col("html").cast("string")
    own = pages.select(html.alias("html")).where(F.length("html").between(1, SAMPLE_CHARS))
    own = own.select(F.xxhash64("html").alias("draw"), "html")
    draws = [row.draw for row in own.select("draw").distinct().orderBy("draw").limit(SAMPLE_PAGES).collect()]
    drawn = own.where(F.col("draw").isin(draws)).groupBy("draw").agg(F.min("html").alias("html"))
    return fit([row.html for row in drawn.orderBy("draw").collect()])


def texts(network: BiLstm | None, pages: list[str]) -> list[str]:
    """The main text of each page."""
    found = [blocks(page) for page in pages]
    full = [page for page in found if page]
    out = [""] * len(pages)
    if network is None or not full:
        return out
    chosen = network.probabilities(Batch.of([vectors(page) for page in full])) >= 0.5
    at = 0
    for number, page in enumerate(found):
        keep = chosen[at : at + len(page)]
        at += len(page)
        out[number] = "\n".join(b.clean for b, kept in zip(page, keep) if kept)
    return out


def extracted(pages: DataFrame, network: BiLstm | None) -> DataFrame:
    """page_id, url and main text of every page."""
    held = shared(pages.sparkSession, network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = held()
        for batch in batches:
            html = batch.column("html")
            first = 0
            while first < len(html):
                some, size = [], 0
                while first + len(some) < len(html) and size < AT_ONCE:
                    some.append(html[first + len(some)].as_py() or "")
                    size += len(some[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id").slice(first, len(some)),
                        batch.column("url").slice(first, len(some)),
                        pa.array(texts(network, some), pa.string()),
                    ],
                    ["page_id", "url", "text"],
                )
                first += len(some)

    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return source.mapInArrow(run, "page_id long, url string, text string")
