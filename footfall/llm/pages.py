"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, each with its open elements. A block's features
are its ancestors' tags and the words of their class, id and role attributes, its own tag, and the shape of its text.
The field has two labels (article or not), trained by likelihood gradients on labelled pages and decoded by Viterbi.

Labelled pages: at most TRAINING pages, those with the least hash of `page_id` among the pages that have text inside
<article> or <main>; a block inside is article. Pages without such text say nothing about where their article is and are
not learned from. Since real sites mark articles in many ways, each page is also set anew in layouts of several kinds:
its paragraphs in an article, main, section or div with a usual name, and its menus, notices, adverts, forms, side
columns and reader comments around and inside it, each with its known label. Where a table has fewer labelled pages than
TRAINING, or none, layouts of shipped texts take their place; there the article may also be in a bare section, td or div.

Defined cases: null or empty html has the text "" and 0 characters; markup that never closes is read to the end of the
page; pages without article blocks give ""; repeated rows are read each; an empty table gives no rows.
"""

from __future__ import annotations

import html as references
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most pages the field is fitted on, and the passes over them.
TRAINING = 120
LAYOUTS = 3
EPOCHS = 4
SLOTS = 1 << 14

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_NAME = re.compile(r"[a-z]+")
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
HIDDEN = frozenset("head script style noscript template svg math iframe object textarea select title button".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag on the left ends an open element on the right, as far as the nearest container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CONTAINERS = frozenset("ul ol dl table article section div main body aside header footer nav form blockquote".split())


class Block(NamedTuple):
    text: str
    path: tuple[tuple[str, str], ...]  # (tag, words of its attributes), from the outside in
    linked: int  # characters inside links


def blocks(page: str) -> list[Block]:
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    path: tuple[tuple[str, str], ...] = ()
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(text, path, linked))
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal path, linked
        if not text or any(tag in HIDDEN for tag, _ in stack):
            return
        text = references.unescape(text)
        if not parts or not "".join(parts).strip():
            path = tuple(stack)
        parts.append(text)
        if any(tag == "a" for tag, _ in stack):
            linked += len(text)

    at = 0
    while token := _TOKEN.search(page, at):
        add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["end"]:
            if tag not in INLINE:
                flush()
            if any(open_tag == tag for open_tag, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag == "br":
            parts.append(" ")
        if tag not in INLINE:
            flush()
            ends = CLOSES.get(tag, {"p"}) | {"p"}
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends:
                    del stack[depth:]
                    break
                if stack[depth][0] in CONTAINERS:
                    break
        if tag in VOID or token["attrs"].endswith("/"):
            continue
        words = " ".join(w for m in _ATTRIBUTE.finditer(token["attrs"]) for w in _NAME.findall((m[2] or m[3] or m[4] or "").lower()))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            continue
        stack.append((tag, words))
    add(page[at:])
    flush()
    return found


def features(page: list[Block]) -> list[list[int]]:
    rows = []
    for block in page:
        names = {"bias"}
        for tag, words in block.path:
            names.add(f"in {tag}")
            names.update(f"named {w}" for w in words.split())
        block_tags = [(tag, words) for tag, words in block.path if tag not in INLINE]
        if block_tags:
            names.add(f"own {block_tags[-1][0]}")
            names.update(f"own named {w}" for w in block_tags[-1][1].split())
        size = len(block.text)
        names.add(f"size {min(size, 2000).bit_length()}")
        names.add(f"linked {10 * block.linked // max(size, 1) // 3}")
        names.add(f"stop {block.text[-1] in '.!?:;'}")
        names.add(f"words {min(block.text.count(' ') + 1, 64).bit_length()}")
        rows.append(sorted({zlib.crc32(n.encode()) % SLOTS for n in names}))
    return rows


class Field:
    """Two labels; `weights` score label 1 against 0 by feature, `moves` score label pairs."""

    def __init__(self):
        self.weights = np.zeros(SLOTS)
        self.moves = np.zeros((2, 2))

    def emissions(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[row].sum() for row in rows])

    def learn(self, rows: list[list[int]], labels: list[int], rate: float) -> None:
        scores, n = self.emissions(rows), len(rows)
        emit = np.stack((np.zeros(n), scores), axis=1)
        ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = emit[0]
        for i in range(1, n):
            ahead[i] = emit[i] + np.logaddexp(ahead[i - 1, 0] + self.moves[0], ahead[i - 1, 1] + self.moves[1])
        for i in range(n - 2, -1, -1):
            step = back[i + 1] + emit[i + 1]
            back[i] = np.logaddexp(self.moves[:, 0] + step[0], self.moves[:, 1] + step[1])
        total = np.logaddexp(*ahead[-1])
        chance = np.exp(ahead[:, 1] + back[:, 1] - total)
        for i, row in enumerate(rows):
            self.weights[row] += rate * (labels[i] - chance[i])
        if n > 1:
            joint = np.exp(ahead[:-1, :, None] + self.moves[None] + (emit[1:] + back[1:])[:, None, :] - total).sum(axis=0)
            seen = np.zeros((2, 2))
            np.add.at(seen, (labels[:-1], labels[1:]), 1)
            self.moves += rate * (seen - joint) / n

    def decode(self, rows: list[list[int]]) -> list[int]:
        if not rows:
            return []
        scores = self.emissions(rows).tolist()
        (a, b), (c, d) = self.moves.tolist()
        zero, one, back = 0.0, scores[0], []
        for score in scores[1:]:
            back.append((zero + a < one + c, zero + b < one + d))
            zero, one = max(zero + a, one + c), score + max(zero + b, one + d)
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


_MAIN = (
    "article", "main", "section class='post'", "div class='content'", "div id='main-content'", "div class='entry-content'",
    "div class='article-body'", "div class='post-text'", "section class='story'", "div role='main'",
)
_AROUND = (
    "nav", "header", "footer", "aside", "div class='menu'", "div class='sidebar'", "div class='ad'", "div class='advert banner'", "div id='cookie-notice'",
    "div class='notice'", "form", "form class='newsletter'", "ul class='breadcrumb'", "div class='related'", "div class='share'", "div id='footer'", "div id='header'",
    "div class='promo sponsored'", "div role='navigation'", "section class='sidebar widget'",
)
_COMMENTS = ("section id='comments'", "div class='comments'", "div class='comment-list'", "ol class='comments reader'", "div class='discussion replies'")


#: Names that say nothing; only the layouts of shipped texts use them.
_BARE = ("section", "td", "td valign='top'", "div", "div")
#: Features see the shape of a text, not its words.
_HEADINGS = (
    "Rain in the valley", "A new bridge for the old town", "What the harvest brought this year", "Notes on repairing clocks", "The library opens again",
    "How to keep bread fresh", "Letters from the coast", "Results of the spring survey", "Why the river changed its course", "Three walks in the hills",
)
_SENTENCES = (
    "The work began in the first days of March and took longer than anyone had thought.", "Nobody was hurt.", "Most of the visitors come by train, walk along the lake and stay for a night or two.",
    "In the end the council agreed to pay half of the costs, and the rest came from the people of the village.", "It had rained for a week.", "She kept the old tools in a box under the stairs, oiled and wrapped in cloth.",
    "A second test gave the same result, which surprised even those who had planned it.", "The road was closed until noon, and the market had to move to the square behind the church.", "Is that too much to ask?",
    "He learned the trade from his father, who had learned it from a man called Anders.", "Prices rose again, though more slowly than the year before: by two per cent in the towns and by three in the country.", "Let the dough rest for an hour.",
    "Some of the figures are estimates, since two stations sent no data in the winter months.", "There is more to see than a single day allows.", "After the war the house stood empty, the garden grew wild, and the children of the street made it their own.",
    "We asked four readers what they thought of it.", "The answer is simple.", "What remains is a wall, a well and a row of trees that somebody must have planted a hundred years ago.",
)
_OTHER = (
    "Home", "News", "About us", "Contact", "Log in", "Terms of use", "Privacy", "Share", "More", "Next page", "Related stories", "Subscribe", "Top of page", "Sports", "Weather", "Archive 2019",
    "© 2021 The publisher. All rights reserved.", "This site uses cookies. Accept", "Buy now and save 20%", "Posted by guest on Monday", "Sign up for our newsletter and never miss a story", "Advertisement",
    "Great article, thanks!", "I don't agree with that at all. They said the same last year.", "Only this week: shoes for the whole family at half the price.", "Follow us", "3 comments", "Reply",
)


def shipped(chance: random.Random) -> tuple[list[str], list[str]]:
    """Texts of an invented article and of what stands around it."""
    article = [chance.choice(_HEADINGS)] if chance.random() < 0.8 else []
    article += [" ".join(chance.choices(_SENTENCES, k=chance.randint(1, 6))) for _ in range(chance.randint(2, 12))]
    return article, chance.sample(_OTHER, chance.randint(5, len(_OTHER)))


def layouts(article: list[str], other: list[str], chance: random.Random, main: tuple[str, ...] = _MAIN) -> tuple[list[Block], list[int]]:
    """A page set anew: its blocks and their labels."""
    escape = references.escape
    other = other or ["more"]

    def wrap(opening: str, inner: str) -> str:
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def line() -> str:
        pool = other if chance.random() < 0.6 or not article else article
        return chance.choice(pool)

    def aside(opening: str) -> str:
        kind = chance.random()
        if kind < 0.4:
            inner = "<ul>" + "".join(f"<li><a href='/'>{escape(line()[:40])}</a></li>" for _ in range(chance.randint(1, 6))) + "</ul>"
        elif kind < 0.7:
            inner = "".join(f"<p>{escape(line())}</p>" for _ in range(chance.randint(1, 3)))
        else:
            inner = escape(line())
        return wrap(opening, inner)

    def body() -> str:
        out = []
        for i, text in enumerate(article):
            # U+0001 marks the article's own blocks; it is taken off before features are made.
            tag = "h1" if i == 0 else chance.choice(("p", "p", "p", "p", "h2", "li", "blockquote", "div"))
            out.append(wrap(tag, "\x01" + escape(text)))
            if chance.random() < 0.08:
                out.append(aside(chance.choice(("div class='ad'", "aside", "div class='share'", "div class='related'", "figure class='promo'"))))
        return "".join(out)

    before = "".join(aside(o) for o in chance.sample(_AROUND, chance.randint(1, 4)))
    after = "".join(aside(o) for o in chance.sample(_AROUND, chance.randint(1, 4)))
    comments = wrap(chance.choice(_COMMENTS), "".join(f"<div class='comment'><p>{escape(line())}</p></div>" for _ in range(chance.randint(1, 5)))) if chance.random() < 0.6 else ""
    inside = chance.random() < 0.3
    core = wrap(chance.choice(main), body() + (comments if inside else ""))
    if chance.random() < 0.4:
        core = wrap(chance.choice(("div class='wrapper'", "div id='page'", "main", "div class='container'")), core)
    found = blocks(f"<body>{before}{core}{'' if inside else comments}{after}</body>")
    labels = [int("\x01" in block.text) for block in found]
    return [block._replace(text=block.text.replace("\x01", "") or "-") for block in found], labels


def marked(found: list[Block]) -> list[int]:
    return [int(any(tag in ("article", "main") for tag, _ in block.path)) for block in found]


def fit(pages: list[str], seed: int = 7) -> Field:
    chance, examples, labelled = random.Random(seed), [], 0
    for page in pages:
        found = blocks(page)
        labels = marked(found)
        if not any(labels):
            continue
        labelled += 1
        examples.append((features(found), labels))
        article, other = [b.text for b, y in zip(found, labels) if y], [b.text for b, y in zip(found, labels) if not y]
        for _ in range(LAYOUTS):
            again, marks = layouts(article, other, chance)
            examples.append((features(again), marks))
    for _ in range(LAYOUTS * max(0, TRAINING - labelled)):
        again, marks = layouts(*shipped(chance), chance, _MAIN + _BARE)
        examples.append((features(again), marks))
    field = Field()
    for epoch in range(EPOCHS):
        chance.shuffle(examples)
        for rows, labels in examples:
            field.learn(rows, labels, 0.2 / (1 + epoch))
    return field


def article_text(page: str | None, field: Field) -> str:
    found = blocks(page) if page else []
    return "\n".join(block.text for block, label in zip(found, field.decode(features(found))) if label)


def training_pages(pages: DataFrame, most: int = TRAINING) -> list[str]:
    """Pages with text inside <article> or <main>."""
    named = pages.where(F.col("html").rlike(r"(?i)<(article|main)(?![A-Za-z0-9:-])")).select("html", F.xxhash64("page_id").alias("h"))

    def first(df: DataFrame) -> list[str]:
        return [row["html"] for row in df.orderBy("h", F.xxhash64("html")).limit(most).collect()]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[[any(marked(blocks(page))) for page in frame["html"]]]

    picked = first(named)
    if all(any(marked(blocks(page))) for page in picked):
        return picked
    # Some have the tag in a comment or a script, or without text: only then all are read for it.
    return first(named.mapInPandas(run, "html string, h long"))


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages` (page_id, url, html)."""
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    held = named.sparkSession.sparkContext.broadcast(field or fit(training_pages(named)))  # SLOTS weights

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [article_text(page if isinstance(page, str) else None, held.value) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return named.mapInPandas(run, "page_id long, url string, text string, n_chars long")
