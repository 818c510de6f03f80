"""Personal data: fixed base patterns, and a character tagger for what they miss.

The tagger is a bidirectional LSTM with CRF transitions, trained in numpy on
the driver from labelled spans drawn by rule. It reads all stretches of a text
that hold a digit, ``@`` or a spelled sign of an address (``[at]``, ``(dot)``,
the word ``dot``) with ``AROUND`` characters on both sides; around signs, also
``WORDS`` words and whole words only, so no address crosses a stretch's border.
It reads them in overlapping windows. Where windows overlap, their tag scores are averaged, and each stretch is decoded as a whole,
so a span is cut by no window border.

Base spans stay as they are. A tagged span is added where it touches no base
span and has the digits, dots or ``@`` that its kind needs. Null and empty
texts have no spans; repeated ids and rows are read row by row.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.tagger import CODES, Tagger, codes
from spendwatch.llm.textblocks import blocks

KINDS = ["email", "ip", "card", "phone"]
#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)

# The base patterns. Looking back for a digit changes no match, it only avoids rescanning long runs.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRIGGER = re.compile(r"[0-9]+|@|[\[(]\s?(?i:at|dot)\s?[\])]|\b(?i:dot)\b")
AROUND = 24
#: "name at host dot org" has three words before its dot.
WORDS = 3
WORD = re.compile(r"\S+")
#: Addresses with a sign, and addresses that spell signs out; after a plain "at" the dots are spelled out too.
_PART, _AT, _DOT = r"[^\s@.,\[\]()]+", r"\s?[\[(]\s?at\s?[\])]\s?", r"(?:\s?[\[(]\s?dot\s?[\])]\s?|\s+dot\s+)"
ADDRESS = re.compile(r"[^\s@]+\s?@\s?[^\s@]+\.[^\s@]{2,}")
SPELLED = re.compile(rf"[^\s@,\[\]()]+(?:(?:{_AT}|\s?@\s?){_PART}(?:(?:\.|{_DOT}){_PART})+|\s+at\s+{_PART}(?:{_DOT}{_PART})+)", re.IGNORECASE)
WINDOW = 96
STEP = 64
#: Windows that go through the network together.
TOGETHER = 256
#: Signs and dots of spelled addresses.
SPELLINGS = [(" at ", " dot "), (" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "."), (" [at] ", "."), (" (at) ", " (dot) ")]
TRAIN_WINDOWS = 1_600
TRAIN_LENGTH = 64
EPOCHS = 9
SEED = 31

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """``(kind, start, end)`` of the base patterns, leftmost and non-overlapping per kind."""
    out: list[Span] = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            done = found.end()
        at = text.find("@", max(at + 1, done))
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and, with whole words, around ``@`` and spelled signs."""
    out: list[list[int]] = []
    starts: list[int] = []
    stops: list[int] = []
    for m in TRIGGER.finditer(text):
        start, stop = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if not "0" <= m[0][0] <= "9":
            if not starts:
                starts, stops = map(list, zip(*(w.span() for w in WORD.finditer(text))))
            first = min(bisect_right(starts, start), bisect_right(starts, m.start()) - WORDS) - 1
            last = max(bisect_left(stops, stop), bisect_left(stops, m.end()) + WORDS)
            start, stop = min(start, starts[max(0, first)]), max(stop, stops[min(last, len(stops) - 1)])
            while out and start <= out[-1][0]:
                stop = max(stop, out.pop()[1])
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def plausible(kind: int, text: str) -> bool:
    """Whether a tagged span has what its kind needs."""
    digits = _digits(text)
    if kind == 0:
        return ADDRESS.fullmatch(text) is not None or SPELLED.fullmatch(text) is not None
    if kind == 1:
        parts = re.split(r"[.\s\[\]]+", text.strip("[]"))
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and re.fullmatch(r"[0-9][0-9 .-]*[0-9]", text) is not None
    return 7 <= len(digits) <= 15 and re.fullmatch(r"\+?[(0-9][0-9 ().\/-]*[0-9]", text) is not None and (text[0] in "+(" or re.search(r"[ ().\/-]", text) is not None)


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans that the tagger finds in each text, decoded over whole stretches."""
    parts = [(k, a, b) for k, text in enumerate(texts) for a, b in stretches(text)]
    windows = [(p, s) for p, (_, a, b) in enumerate(parts) for s in range(0, max(1, b - a - (WINDOW - STEP)), STEP)]
    scores = [np.zeros((b - a, TAGS)) for _, a, b in parts]
    weight = [np.zeros((b - a, 1)) for _, a, b in parts]
    # characters near a window's border count less
    trust = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1))[:, None].astype(float)
    for i in range(0, len(windows), TOGETHER):
        group = windows[i : i + TOGETHER]
        ids = np.full((WINDOW, len(group)), CODES)
        for w, (p, s) in enumerate(group):
            k, a, b = parts[p]
            piece = codes(texts[k][a + s : min(b, a + s + WINDOW)])
            ids[: len(piece), w] = piece
        made = tagger.emissions(ids)
        for w, (p, s) in enumerate(group):
            n = min(WINDOW, len(scores[p]) - s)
            scores[p][s : s + n] += made[:n, w] * trust[:n]
            weight[p][s : s + n] += trust[:n]
    out: list[list[Span]] = [[] for _ in texts]
    for (k, a, _), score, total in zip(parts, scores, weight):
        tags = tagger.decode(score / total)
        kind = (tags + 1) // 2
        edge = np.flatnonzero((np.diff(kind, prepend=0) != 0) | (tags % 2 == 1)).tolist() + [len(tags)]
        out[k] += [(int(kind[x]) - 1, a + x, a + y) for x, y in zip(edge, edge[1:]) if kind[x] > 0]
    return out


def all_spans(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    out = []
    for text, found in zip(texts, tagged_spans(tagger, texts)):
        base, added = base_spans(text), []
        for kind, a, b in found:
            while a < b and text[a] in " \n\t.,;:":
                a += 1
            while a < b and text[b - 1] in " \n\t.,;:":
                b -= 1
            if a < b and plausible(kind, text[a:b]) and all(b <= x or y <= a for _, x, y in base):
                added.append((kind, a, b))
        out.append((sorted(base), added))
    return out


def labelled_windows(count: int = TRAIN_WINDOWS, length: int = TRAIN_LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags (step, window) of texts drawn by rule with labelled spans."""
    rng = random.Random(seed)
    letters = "aaabcdeeeefghiiiklmnooprsttuvw"
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    word = lambda: "".join(rng.choices(letters + "éèüñç", k=rng.randint(2, 9)))
    plain = lambda: "".join(rng.choices(letters, k=rng.randint(2, 8)))

    def personal() -> tuple[str, int]:
        kind = rng.randrange(4)
        if kind == 0:
            local = rng.choice([plain(), number(2), plain() + number(2), plain() + rng.choice("._+-") + plain()])
            sign, dot = rng.choice([("@", "."), (" @ ", "."), (" @ ", "."), rng.choice(SPELLINGS), rng.choice(SPELLINGS)])
            return local + sign + plain() + rng.choice(["", number(1)]) + dot + rng.choice(["", plain() + dot]) + rng.choice(["com", "org", "net", "de", "fr"]), kind
        if kind == 1:
            return rng.choice([".", ".", ".", "[.]"]).join(str(rng.randint(0, 255)) for _ in range(4)), kind
        if kind == 2:
            between = rng.choice(["", "", " ", "-", "."])
            return between.join(number(4) for _ in range(4)) if rng.random() < 0.8 else number(rng.randint(13, 19)), kind
        area, middle, end = number(3), number(3), number(4)
        form = rng.choice(["+{c} ({a}) {m}-{e}", "+{c} {a} {m} {e}", "({a}) {m}-{e}", "{a}-{m}-{e}", "{a}.{m}.{e}", "+{c}{a}{m}{e}", "0{a}/{m}{e}", "{a} {m} {e}"])
        return form.format(c=rng.choice(["1", "33", "49", "34"]), a=area, m=middle, e=end), kind

    def other() -> str:
        return rng.choice(
            [
                lambda: "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40]))), lambda: f"{rng.randint(1900, 2030)}", lambda: f"{number(4)}-{number(2)}-{number(2)}",
                lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 20)}", lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", lambda: number(rng.randint(1, 6)),
                lambda: f"{number(2)}:{number(2)}", lambda: f"${number(2)}.{number(2)}", lambda: plain() + number(2), lambda: "@" + plain(), lambda: number(1) + "%",
                lambda: f'token = "{"".join(rng.choices("0123456789abcdef", k=40))}"', lambda: "Version 2.0.", lambda: number(rng.randint(20, 30)),
                lambda: plain() + " at " + plain(), lambda: plain() + " dot " + plain(),
            ]
        )()

    ids, tags = np.zeros((length, count), np.int64), np.zeros((length, count), np.int64)
    for w in range(count):
        text, tag = "", []
        while len(text) < length + AROUND:
            r = rng.random()
            if r < 0.22:
                piece, kind = personal()
                labels = [1 + 2 * kind] + [2 + 2 * kind] * (len(piece) - 1)
            else:
                piece = other() if r < 0.36 else word().capitalize() if r < 0.45 else word()
                labels = [0] * len(piece)
            tail = rng.choice([" ", " ", " ", " ", ", ", ". ", ".\n", "\n", "%%% ", " | "])
            text, tag = text + piece + tail, tag + labels + [0] * len(tail)
        shift = rng.randint(0, AROUND)
        ids[:, w], tags[:, w] = codes(text)[shift : shift + length], tag[shift : shift + length]
    return ids, tags


def trained() -> Tagger:
    """The tagger, trained from labelled spans; deterministic."""
    tagger = Tagger(TAGS)
    tagger.train(*labelled_windows(), epochs=EPOCHS)
    return tagger


def _spelled(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, base counts per kind, ``base_sha256`` and ``spans`` of every row of ``docs``."""
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    weights = tagger.w  # of fixed size

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Tagger(TAGS, weights)
        for batch, raw in blocks(batches, "_text"):
            texts = [t.decode() for t in raw]
            made = all_spans(here, texts)
            counts = [[sum(s[0] == k for s in base) for base, _ in made] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(_spelled(base).encode()).hexdigest() for base, _ in made], pa.string()),
                    pa.array([_spelled(base + added) for base, added in made], pa.string()),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = only.schema["doc_id"].dataType.simpleString()
    return only.mapInArrow(find, f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string")
