"""Secrets by corpus-wide ownership frequency, in DataFrame functions only.

Base patterns give assignments, access keys and hexadecimal runs. Their values,
and long random-looking tokens outside of them, are candidates. Over the whole
corpus each candidate's hash is counted by distinct repositories and distinct
sources (the owners). A repository is a text with its near copies: each text
has ``SKETCHES`` minwise shingles, and the number of repositories is the
smallest number of different ones among the texts that hold the value. Two
texts with four fifths of their shingles in common thus count as one but once
in 600 times, and so do any number of copies that differ in a word. A value is
a copied example when more than ``COPIED_OWNERS`` owners and more than
``COPIED_REPOS`` repositories hold it, or more than ``COMMON_REPOS``
repositories of whatever owners. Other values that look random are live and
added as spans of kind ``live``.

Places are found inside the row: what a pattern matches and what lies between
matches alternate, so the lengths of both give code-point offsets. Only
candidates are exploded, and they are counted as distinct (hash, owner) and
(hash, sketch) pairs first, so a value that a third of all rows hold is combined before it is
shuffled.

Null and empty texts have no spans. A null source is an owner of its own. Ids
are not read. Repeated rows are separate rows; they count as one repository. A
text of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.scratch import written

# The base patterns.
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = f"(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?({VALUE})"
ACCESS = "AKIA[A-Z0-9]+"
HEXES = "[0-9a-f]{32,}"  # the runs of 32 and more among all maximal runs
MIN_VALUE = 8
MIN_ACCESS = 16
#: Loose candidates: maximal runs of letters, digits, ``_`` and ``-``; and those with ``/`` and ``+`` among
#: them and ``=`` behind, where they have the form of a Base64 key. Inline data after ``;base64,`` is neither.
MIN_LOOSE = 24
INLINE = ";base64,"
DATA = f"{INLINE}[A-Za-z0-9/+_-]+={{0,2}}"
PART = f"{DATA}|[A-Za-z0-9_-]{{{MIN_LOOSE},}}"
WHOLE = f"{DATA}|[A-Za-z0-9/+_-]{{{MIN_LOOSE},}}={{0,2}}"
KEY_FORM = "^[A-Za-z0-9]*[/+=][A-Za-z0-9/+]*={0,2}$"
#: A random token changes between capitals, small letters, digits and signs at this share of its
#: places and more (a random Base62 string at 62 percent, names in camel case at about 30).
CHANGES, OF_PLACES = 3, 8
CLASSES = ["A-Z", "a-z", "0-9", "^A-Za-z0-9"]
#: Words of a shingle, and minwise shingles of a text: that many parts of one digest of 32 signs.
SHINGLE, SKETCHES, SKETCH_SIGNS = 3, 4, 8
#: A live value has at least this many characters, among them digits and letters, and this many different ones.
LIVE_LENGTH = 16
LIVE_DIFFERENT = 8
#: A value that more owners and more repositories than these hold is a copied example,
COPIED_OWNERS = 1
COPIED_REPOS = 1
#: and so is one that more repositories than this hold, whoever owns them.
COMMON_REPOS = 100
KINDS = ["assign", "access", "hex", "live"]
SPAN = "array<struct<start:bigint,kind:int,stop:bigint,value:string>>"
HELD = "array<struct<value:string,n_owners:bigint,n_repos:bigint>>"


def _found(text: str, pattern: str, kind: int, group: int = 0) -> Column:
    """Spans of all matches as ``start, kind, stop, value``; ``value`` is the given group."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(hits), F.lit(1))).alias("gap"), hits.alias("hit"), values.alias("value"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(state: Column, step: Column) -> Column:
        begin = state["at"] + F.char_length(step["gap"])
        end = begin + F.char_length(step["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("stop"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).cast(SPAN).alias("spans"))

    return F.when(F.col(text).rlike(pattern), F.aggregate(steps, start, add)["spans"]).otherwise(F.array().cast(SPAN))


def _values(spans: Column) -> Column:
    """The places of the spans' values; a value stands at the end of an assignment."""
    place = lambda s: F.struct((s["stop"] - F.char_length(s["value"])).alias("start"), F.lit(3).alias("kind"), s["stop"].alias("stop"), s["value"].alias("value"))
    return F.array_distinct(F.transform(spans, place))


def _spelled(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _looks_random(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.char_length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LIVE_DIFFERENT)


def _changes_often(value: Column) -> Column:
    """All three classes of characters are there, and many changes between them."""
    short = value
    for members, one in zip(CLASSES, ("A", "a", "0", "-")):
        short = F.regexp_replace(short, f"[{members}]+", one)
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return mixed & (OF_PLACES * (F.char_length(short) - 1) >= CHANGES * (F.char_length(value) - 1))


def _loose(text: str) -> Column:
    part = F.filter(_found(text, PART, 3), lambda s: ~s["value"].startswith(INLINE) & _changes_often(s["value"]))
    form = lambda v: v.rlike(KEY_FORM) & (F.char_length(v) % 4 == 0) & _changes_often(v)
    return F.concat(part, F.filter(_found(text, WHOLE, 3), lambda s: ~s["value"].startswith(INLINE) & form(s["value"])))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, although a lambda reads it for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sketches(text: str) -> Column:
    """The least parts of the digests of all shingles of a text."""

    def shingles(words: Column) -> Column:
        several = F.transform(F.sequence(F.lit(1), F.size(words) - SHINGLE + 1), lambda i: F.md5(F.array_join(F.slice(words, i, SHINGLE), " ").cast("binary")))
        return F.when(F.size(words) < SHINGLE, F.array(F.md5(F.array_join(words, " ").cast("binary")))).otherwise(several)

    def least(digests: Column) -> Column:
        part = lambda k: F.array_min(F.transform(digests, lambda d: F.substring(d, k * SKETCH_SIGNS + 1, SKETCH_SIGNS)))
        return F.array(*map(part, range(SKETCHES)))

    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    return _once(_once(words, shingles), least)


def scan_secrets(docs: DataFrame, text_col: str = "text", owner_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row``, a struct of its ``keep`` columns (default: all), base counts, spans and live values.

    The added columns are ``n_assign, n_access, n_hex, base_sha256, spans,
    n_live, n_shared, live, held, hidden``; ``n_shared`` counts candidates of several
    owners, ``held`` has ``value, n_owners, n_repos`` of each candidate value,
    and ``hidden`` the places to redact: values of base spans that are no copied
    example, and live values.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns])
    rows = docs.select(kept.alias("row"), F.col(owner_col).cast("string").alias("owner"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.select(
        "row", "owner", "text",
        F.filter(_found("text", ASSIGN, 0, 1), lambda s: F.char_length(s["value"]) >= MIN_VALUE).alias("assign"),
        F.filter(_found("text", ACCESS, 1), lambda s: F.char_length(s["value"]) >= MIN_ACCESS).alias("access"),
        _found("text", HEXES, 2).alias("hex"),
        _loose("text").alias("loose"),
    )
    rows = rows.withColumn("candidates", _values(F.concat("assign", "access", "hex", "loose"))).withColumn("sketches", F.when(F.size("candidates") > 0, _sketches("text"))).drop("text")
    stage = written(rows.withColumn("base", F.concat("assign", "access", "hex")).withColumn("key", F.monotonically_increasing_id()))

    every = stage.filter(F.size("candidates") > 0).select("key", "sketches", "owner", F.explode("candidates").alias("span")).withColumn("hash", F.sha2("span.value", 256))
    owners = every.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("n_owners"))
    sketched = every.select("hash", F.posexplode("sketches").alias("place", "least")).distinct()
    repos = sketched.groupBy("hash", "place").agg(F.count("*").alias("n")).groupBy("hash").agg(F.min("n").alias("n_repos"))
    known = owners.join(repos, "hash")
    is_copied = ((F.col("n_owners") > COPIED_OWNERS) & (F.col("n_repos") > COPIED_REPOS)) | (F.col("n_repos") > COMMON_REPOS)
    verdict = every.select("key", "span", "hash").join(known, "hash").withColumn("is_copied", is_copied)
    per_row = verdict.groupBy(F.col("key").alias("_key")).agg(
        F.sort_array(F.collect_list(F.when(~F.col("is_copied"), F.col("span")))).alias("own"),
        F.count(F.when(F.col("n_owners") > 1, 1)).alias("n_shared"),
        F.sort_array(F.collect_set(F.struct("span.value", "n_owners", "n_repos"))).alias("held"),
    )
    joined = stage.join(per_row, F.col("key") == F.col("_key"), "left")
    own = F.coalesce("own", F.array().cast(SPAN))
    live = F.filter(own, lambda s: _looks_random(s["value"]))
    added = {
        "n_assign": F.size("assign").cast("bigint"), "n_access": F.size("access").cast("bigint"), "n_hex": F.size("hex").cast("bigint"),
        "base_sha256": F.sha2(_spelled(F.col("base")), 256), "spans": _spelled(F.concat("base", live)),
        "n_live": F.size(live).cast("bigint"), "n_shared": F.coalesce("n_shared", F.lit(0)),
        "live": F.array_distinct(F.transform(live, lambda s: s["value"])), "held": F.coalesce("held", F.array().cast(HELD)),
        "hidden": F.sort_array(F.array_union(live, F.array_intersect(own, _values(F.col("base"))))),
    }
    return joined.select("row", *(c.alias(n) for n, c in added.items()))


def counted_holders(held: str) -> Column:
    """``hash:owners:repositories`` of each candidate value, sorted and joined by commas; the hash is the first 16 signs of SHA-256."""
    one = lambda h: F.concat_ws(":", F.substring(F.sha2(h["value"], 256), 1, 16), h["n_owners"].cast("string"), h["n_repos"].cast("string"))
    return F.array_join(F.array_sort(F.transform(held, one)), ",")


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with each of the places, sorted by start, replaced by ``mark``; overlapping ones become one mark."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("pieces"))
    piece = lambda begin, length: F.substring(text, (begin + 1).cast("int"), length.cast("int"))

    def add(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        more = F.when(apart, F.concat(state["pieces"], F.array(piece(state["at"], s["start"] - state["at"])))).otherwise(state["pieces"])
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), more.alias("pieces"))

    done = lambda state: F.array_join(F.concat(state["pieces"], F.array(piece(state["at"], F.char_length(text).cast("bigint")))), mark)
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, done)).otherwise(text)


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """All rows and columns of ``docs``; in the text every value of a base span and every live value become ``mark``.

    Copied examples stay. A live value is replaced wherever it stands, also inside longer tokens.
    """
    clean = F.aggregate("live", _masked(F.col("row.text"), F.col("hidden"), mark), lambda text, value: F.replace(text, value, F.lit(mark)))
    columns = [clean.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return scan_secrets(docs).select(*columns)
