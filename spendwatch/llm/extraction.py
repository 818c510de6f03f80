"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Each leaf block gets binary features of its ancestors (tags, and the words of
their class, id and role), of its own tag, and of its text. Two states, main
text and rest, form a chain in page order; weights of features and of state
changes maximise the conditional likelihood of labelled pages. A page is
decoded by Viterbi over its whole chain.

The labelled pages are drawn by rule in ``labelled_pages``: layouts with and
without semantic tags, with menus, sidebars, notices, adverts, forms, footers
and reader comments. Training takes a few seconds on the driver; decoding is a
narrow pass over whole pages.

A null or empty page, or one without main blocks, has an empty text. Repeated
ids and rows are extracted row by row; a null id or url stays null.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.domblocks import Block, Node, leaf_blocks

PAGES = 600
EPOCHS = 300
RATE = 0.5
PENALTY = 3e-4
SEED = 23
#: Pages decoded together, and places of their common table: a page with more blocks is decoded alone.
TOGETHER = 64
PLACES = 1 << 16


def features(block: Block) -> list[str]:
    """Names of the features that hold for a block."""
    return [*_path_features(block.path), *_text_features(block)]


def _path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    out = set() if any(" " in element for element in path) else {"names:none"}
    for k, element in enumerate(path):
        tag, *names = element.split(" ")
        out.add("in:" + tag)
        out.update("name:" + n for n in names)
        if k == len(path) - 1:
            out.add("own:" + tag)
    return tuple(sorted(out))


def _text_features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    linked = min(1.0, block.linked / max(1, len(text)))
    return [
        "words:" + str(min(int(words).bit_length(), 8)),
        "linked:" + ("none" if linked == 0 else "part" if linked < 0.5 else "most"),
        "ends:" + ("stop" if text[-1] in ".!?…" else "other"),
        "starts:" + ("upper" if text[0].isupper() else "digit" if text[0].isdigit() else "sign" if not text[0].isalnum() else "lower"),
        *(["mark:©"] if "©" in text else []),
    ]


class Chain:
    """Two-state chain: state 1 is main text."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray, begin: np.ndarray):
        self.index, self.weights, self.moves, self.begin = index, weights, moves, begin

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        """Score of either state for each block."""
        out = np.zeros((len(blocks), 2))
        for k, block in enumerate(blocks):
            out[k] = self._around(block.node) + self._sum(_text_features(block))
        return out

    def _around(self, node: Node | None) -> np.ndarray:
        """Weights of the elements around a block. What an element adds to the one above is worked out once for each element."""
        todo, above = [], node
        while above is not None and above.score is None:
            todo.append(above)
            above = above.above
        for one in reversed(todo):
            tag, *names = one.name.split(" ")
            score, seen = (one.above.score, one.above.seen) if one.above is not None else (self._sum([]), frozenset())
            new = ({"in:" + tag} | {"name:" + n for n in names}) & self.index.keys() | ({"named"} if names else set())
            one.score, one.seen = (score, seen) if new <= seen else (score + self._sum(new - seen), seen | new)
        if node is None:
            return self._sum(["names:none"])
        return node.score + self._sum(["own:" + node.tag, *([] if "named" in node.seen else ["names:none"])])

    def _sum(self, names: Iterable[str]) -> np.ndarray:
        at = [self.index[n] for n in names if n in self.index]
        return self.weights[at].sum(axis=0)

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi paths of several chains at once, padded to the longest."""
        longest = max((len(s) for s in scores), default=0)
        if not longest:
            return [np.zeros(0, bool) for _ in scores]
        sizes = np.array([len(s) for s in scores])
        padded = np.zeros((longest, len(scores), 2))
        for k, s in enumerate(scores):
            padded[: len(s), k] = s
        best = self.begin + padded[0]
        back = np.zeros((longest, len(scores), 2), np.int8)
        for t in range(1, longest):
            via = best[:, :, None] + self.moves
            back[t] = via.argmax(axis=1)
            on = t < sizes
            best = np.where(on[:, None], via.max(axis=1) + padded[t], best)
        state, out = best.argmax(axis=1), np.zeros((longest, len(scores)), bool)
        for t in range(longest - 1, -1, -1):
            on = t < sizes
            out[t] = on & (state == 1)
            if t:
                state = np.where(on, back[t, np.arange(len(scores)), state], state)
        return [out[:n, k] for k, n in enumerate(sizes)]


def fit(pages: list[tuple[str, list[bool]]]) -> Chain:
    """Chain with the weights that maximise the conditional likelihood of labelled pages (AdaGrad on full passes)."""
    chains = [(leaf_blocks(page), labels) for page, labels in pages]
    chains = [(b, labels) for b, labels in chains if len(b) == len(labels) and b]
    names = [[features(x) for x in b] for b, _ in chains]
    index = {n: k for k, n in enumerate(sorted({f for page in names for block in page for f in block}))}
    longest, count = max(len(b) for b, _ in chains), len(chains)
    page, place, feature = (np.array(x) for x in zip(*[(p, t, index[f]) for p, rows in enumerate(names) for t, row in enumerate(rows) for f in row]))
    sizes = np.array([len(b) for b, _ in chains])
    on = np.arange(longest)[:, None] < sizes
    truth = np.zeros((longest, count), int)
    for p, (_, labels) in enumerate(chains):
        truth[: len(labels), p] = labels
    flat = place * count + page
    weights, moves, begin = np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)
    seen = [np.full_like(x, 1e-6) for x in (weights, moves, begin)]
    both = on[1:]
    wanted_moves = np.zeros((2, 2))
    np.add.at(wanted_moves, (truth[:-1][both], truth[1:][both]), 1)
    eye = np.eye(2)
    for _ in range(EPOCHS):
        score = np.stack([np.bincount(flat, weights[feature, s], longest * count).reshape(longest, count) for s in (0, 1)], 2)
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = begin + score[0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(ahead[t - 1][:, :, None] + moves, axis=1) + score[t]
            ahead[t] = np.where(on[t][:, None], step, ahead[t - 1])
        whole = np.logaddexp.reduce(ahead[-1], axis=1)
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (score[t + 1] + behind[t + 1])[:, None, :], axis=2)
            behind[t] = np.where(on[t + 1][:, None], step, 0)
        share = np.exp(ahead + behind - whole[None, :, None]) * on[:, :, None]
        pull = share - eye[truth] * on[:, :, None]
        gw = np.stack([np.bincount(feature, pull[place, page, s], len(index)) for s in (0, 1)], 1) / count + PENALTY * weights
        pair = np.exp(ahead[:-1][:, :, :, None] + moves + (score[1:] + behind[1:])[:, :, None, :] - whole[None, :, None, None]) * both[:, :, None, None]
        gm = (pair.sum(axis=(0, 1)) - wanted_moves) / count
        gb = (share[0] - eye[truth[0]]).sum(axis=0) / count
        for x, g, s in zip((weights, moves, begin), (gw, gm, gb), seen):
            s += g * g
            x -= RATE * g / np.sqrt(s)
    return Chain(index, weights, moves, begin)


# Names that pages give to their parts.
MAIN_NAMES = ["article", "content", "main", "post", "entry", "story", "body", "text", "page"]
REST_NAMES = {
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb", "topbar", "tabs"],
    "head": ["header", "masthead", "banner", "logo", "branding", "site"],
    "side": ["sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "tags"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion"],
    "notice": ["cookie", "consent", "notice", "gdpr", "popup", "modal", "alert", "overlay", "newsletter", "subscribe"],
    "comment": ["comments", "comment", "replies", "reply", "discussion", "disqus", "respond"],
    "form": ["form", "search", "login", "signup", "contact", "share", "social"],
    "foot": ["footer", "copyright", "legal", "colophon", "bottom"],
}


def labelled_pages(count: int = PAGES, seed: int = SEED) -> list[tuple[str, list[bool]]]:
    """Pages drawn by rule, with the label of each of their leaf blocks."""
    rng = random.Random(seed)
    syllables = [a + b for a in "b d f g k l m n p r s t v".split() for b in "a e i o u ar en is".split()]

    def phrase(low: int, high: int, stop: bool = False) -> str:
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(low, high))]
        return " ".join(words).capitalize() + ("." if stop else "")

    def text() -> str:
        if rng.random() < 0.15:
            return phrase(1, 4, True)
        return " ".join(phrase(3, 18, True) for _ in range(rng.choice([1, 1, 2, 3, 5])))

    def page() -> tuple[str, list[bool]]:
        labels: list[bool] = []

        def leaf(tag: str, inner: str, main: bool) -> str:
            labels.append(main)
            return f"<{tag}>{inner}</{tag}>"

        def opened(kind: str, semantic: str | None) -> tuple[str, str]:
            tag = semantic if semantic and rng.random() < 0.6 else rng.choice(["div", "div", "section"])
            named = rng.choice(MAIN_NAMES if kind == "main" else REST_NAMES[kind])
            named += rng.choice(["", "", "-inner", "-box", " wrap", "_area"])
            bare = tag == semantic and rng.random() < 0.6 or kind == "main" and rng.random() < 0.35
            attribute = "" if bare else f' {rng.choice(["class", "id"])}="{named}"'
            return f"<{tag}{attribute}>", f"</{tag}>"

        def links(main: bool = False) -> str:
            return "<ul>" + "".join(leaf("li", f'<a href="#">{phrase(1, 3)}</a>', main) for _ in range(rng.randint(2, 7))) + "</ul>"

        def rest(kind: str) -> str:
            a, b = opened(kind, {"menu": "nav", "head": "header", "side": "aside", "form": "form", "foot": "footer"}.get(kind))
            if kind == "menu":
                return a + links() + b
            if kind == "head":
                return a + leaf(rng.choice(["div", "p", "h2"]), phrase(1, 4), False) + (links() if rng.random() < 0.5 else "") + b
            if kind == "side":
                return a + leaf("h3", phrase(1, 3), False) + (links() if rng.random() < 0.6 else leaf("p", text(), False)) + b
            if kind == "form":
                return a + leaf("label", phrase(1, 2), False) + '<input name="q">' + leaf("button", phrase(1, 2), False) + b
            if kind == "comment":
                inner = "".join(leaf(rng.choice(["h4", "div"]), phrase(1, 2), False) + leaf("p", text(), False) for _ in range(rng.randint(1, 4)))
                return a + leaf("h3", phrase(1, 2), False) + inner + b
            if kind == "foot":
                return a + leaf("p", f"&copy; {phrase(1, 3)} &middot; {phrase(1, 6, True)}", False) + (links() if rng.random() < 0.4 else "") + b
            if rng.random() < 0.6:
                labels.append(False)
                return a + text() + b
            return a + leaf("p", text(), False) + (leaf("button", phrase(1, 2), False) if kind == "notice" else "") + b

        def body() -> str:
            a, b = opened("main", rng.choice(["article", "article", "main"]))
            out = [leaf(rng.choice(["h1", "h1", "h2"]), phrase(2, 12), True)] if rng.random() < 0.9 else []
            if rng.random() < 0.3:
                labels.append(True)
                out.append(f"<p><b>{phrase(4, 20)}<br>")
            for _ in range(rng.choice([1, 2, 4, 6, 9])):
                kind = rng.random()
                if kind < 0.62:
                    out.append(leaf("p", text(), True))
                elif kind < 0.7:
                    out.append(leaf(rng.choice(["h2", "h3"]), phrase(1, 6), True))
                elif kind < 0.75:
                    out.append("<ul>" + "".join(leaf("li", phrase(2, 12, rng.random() < 0.5), True) for _ in range(rng.randint(2, 5))) + "</ul>")
                elif kind < 0.78:
                    out.append("<blockquote>" + leaf("p", text(), True) + "</blockquote>")
                elif kind < 0.82:
                    out.append(leaf(rng.choice(["pre", "figcaption", "div"]), phrase(2, 12), True))
                elif kind < 0.85:
                    out.append("<table><tr>" + leaf("td", phrase(1, 3), True) + leaf("td", phrase(1, 3), True) + "</tr></table>")
                else:
                    out.append(rest(rng.choice(["ad", "side", "form", "notice", "comment", "comment"])))
            return a + "".join(out) + b

        often = rng.choice([0.1, 0.5, 0.5])
        before = [k for k in ("notice", "head", "menu", "ad", "form", "side") if rng.random() < often]
        rng.shuffle(before)
        after = [k for k in ("comment", "side", "ad", "form", "notice", "foot") if rng.random() < often]
        made = "".join(map(rest, before)) + body() + "".join(map(rest, after))
        if rng.random() < 0.2:
            return made, labels
        outer = rng.choice(["", "", "<div id='wrap'>", "<div class='page container'>"])
        return f"<html><head><title>{phrase(2, 5)}</title></head><body>{outer}{made}{'</div>' if outer else ''}</body></html>", labels

    return [page() for _ in range(count)]


@lru_cache(maxsize=1)
def trained() -> Chain:
    return fit(labelled_pages())


def _alike(sizes: list[int]) -> list[list[int]]:
    """Pages in groups whose table, padded to the longest, has at most ``PLACES`` places."""
    groups: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if groups and (len(groups[-1]) + 1) * sizes[k] <= PLACES:
            groups[-1].append(k)
        else:
            groups.append([k])
    return groups


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    chain = trained()
    model = (chain.index, chain.weights, chain.moves, chain.begin)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Chain(*model)
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                blocks = [leaf_blocks(page or "") for page in part.column("_html").to_pylist()]
                states: list[np.ndarray] = [np.zeros(0, bool)] * len(blocks)
                for group in _alike([len(b) for b in blocks]):
                    for k, state in zip(group, here.decode([here.emissions(blocks[k]) for k in group])):
                        states[k] = state
                texts = ["\n\n".join(b.text for b, s in zip(page, state) if s) for page, state in zip(blocks, states)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    only = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("_html"))
    kinds = ", ".join(f"{c} {only.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return only.mapInArrow(read, f"{kinds}, text string, n_chars bigint")
