"""Near copies by a chosen-path similarity join.

Each different shingle set is one class, with a signature of minwise tokens. An
independent tree starts from one chosen coordinate: classes whose minwise token
there is equal share a node. A node above ``SMALL`` classes branches: it chooses
``BRANCHES`` further coordinates by a hash of its own path, and a class goes to
one child for each. From ``FIRST_LEVELS`` on only nodes above ``LARGE`` branch,
and only if the first wave has not connected all their classes.
A link of similarity s survives one tree with probability s x, where x is 1 for
a root that is small and 1 - (1 - s x)^2 one level deeper: at least 0.82 at the
threshold of 0.85, so ten independent trees miss such a link about once in 10^7.

Nodes are compared exhaustively inside tasks, in three waves that use what is
proved so far. A leaf or group whose members are already connected is left out.

1. Leaves of the first tree. In a small leaf the signatures give the groups
   worth confirming on full sets. A larger leaf is dealt to chunks of bounded
   total size; the leaf's few leaders are in every chunk, so copies of one text
   become members of their leader in one pass over the leaf.
2. The same for the other trees. Of a larger leaf only members outside its
   largest component are dealt, with leaders of that component in every chunk.
3. Of larger leaves that still have several components, all members outside the
   largest one meet all members, in blocks of ``BLOCK_SIGNED``, by a byte of
   each minwise token. Members with a partner in another component meet again on full sets.

Full sets in one cell are compared by one product of incidence matrices. What
leaves a task is the smallest class that a class is connected with: never the
pairs of a group. The rows of the first two waves grow linearly with a group.

Documents with one shingle set are one class, linked with themselves. A text
without words has an empty set and stays alone, whatever its copies. A null id
joins its class; its component is the smallest id reachable, or null. Repeated
ids and rows are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.llm.scratch import written
from spendwatch.llm.textblocks import Words, blocks, mix
from spendwatch.operators.components import connected_components

TOKENS = 64
TREES = 10
BRANCHES = 2
#: Classes of one node that are compared by signature at once.
SMALL = 48
#: Nodes above ``SMALL`` branch on the levels before this one; and all levels.
FIRST_LEVELS = 2
LEVELS = 8
LARGE = 4_096
#: Shingles and classes in one chunk of a larger leaf, or on one side of a cell of the third wave.
BLOCK_SHINGLES = 400_000
BLOCK_CLASSES = 768
#: Classes of a larger leaf that meet by signature at once.
BLOCK_SIGNED = 4_096
#: Classes of a larger leaf that are in all its chunks.
LEADERS = 32
#: Rows with whole shingle sets in one Arrow batch, and rows without.
SET_ROWS, PLAIN_ROWS = 256, 4_096
#: Rows of the matrix of common shingles that are judged at once.
STRIP = 128
#: Columns multiplied at once.
COLUMNS = 4_096
#: Standard deviations below the expected number of equal tokens at which a pair
#: is still worth confirming: a true link has fewer with probability below 10^-7.
SLACK = 5.7
SEEDS = mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a shorter text is one shingle."""
    value, first = words.windows(size)
    edges = np.searchsorted(first, words.edges)
    out = [np.unique(value[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    for k in np.flatnonzero((words.counts > 0) & (words.counts < size)).tolist():
        whole = words.counts[k : k + 1].astype(np.uint64)
        for h in range(words.edges[k], words.edges[k + 1]):
            whole = mix(whole * np.uint64(31) + words.hashes[h : h + 1])
        out[k] = whole
    return out


def set_class(shingles: np.ndarray) -> bytes:
    """The same 16 bytes for equal sets, different ones for different sets."""
    other = mix(shingles ^ np.uint64(0x5851F42D4C957F2D))
    total = other.sum(keepdims=True) * np.uint64(31) + np.uint64(len(shingles))
    return np.concatenate((shingles.sum(keepdims=True), total)).astype(">u8").tobytes()


def signatures(docs: DataFrame, size: int, tokens: int = TOKENS) -> DataFrame:
    """``id, n_shingles, cls, sig, bytes``: rows of ``_id, _text`` with their set's class, minwise tokens and a byte of each (null for an empty set)."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, shift = (SEEDS[:tokens] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (SEEDS[tokens:] >> np.uint64(32)).astype(np.uint32)
        for part, texts in blocks(batches, "_text"):
            sets = shingle_sets(Words(texts, lower=True), size)
            counts = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(counts)
            flat = np.concatenate([sets[k] for k in full]) if len(full) else np.zeros(0, np.uint64)
            edge = np.cumsum(counts[full]) - counts[full]
            sig = np.zeros((len(full), tokens), np.uint32)
            if len(full):
                half = (flat >> np.uint64(32)).astype(np.uint32)
                for t in range(tokens):
                    token = (half ^ shift[t]) * scale[t]
                    token ^= token >> np.uint32(15)
                    token *= np.uint32(0x85EBCA6B)
                    sig[:, t] = np.minimum.reduceat(token, edge)
            names, sigs, marks = [None] * len(texts), [None] * len(texts), [None] * len(texts)
            low = (sig & np.uint32(255)).astype(np.uint8)
            for i, k in enumerate(full.tolist()):
                names[k], sigs[k], marks[k] = set_class(sets[k]), sig[i].view(np.int32), low[i].tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array(counts), pa.array(names, pa.binary()), pa.array(sigs, pa.list_(pa.int32())), pa.array(marks, pa.binary())],
                names=["id", "n_shingles", "cls", "sig", "bytes"],
            )

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"id {kind}, n_shingles bigint, cls binary, sig array<int>, bytes binary")


def _children(nodes: DataFrame) -> DataFrame:
    """The classes of ``nodes``, once for each child of their node; reads ``key, sig``."""

    def child(choice: int):
        # the coordinate is chosen by the node's path, so it is the same for all its classes
        place = F.pmod(F.xxhash64("key", F.lit(choice)), F.lit(TOKENS))
        return F.xxhash64("key", F.lit(choice), F.element_at("sig", place.cast("int") + 1))

    return nodes.withColumn("key", F.explode(F.array(*[child(c) for c in range(BRANCHES)])))


def leaves_of_trees(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """``key, tree, doc, n, n_shingles, bytes, sig``: the nodes with several classes in which the first levels end, and their sizes.

    ``classes`` has ``doc, n_shingles, sig, bytes``. Node sizes are counted with
    partial sums and joined back, so a node that holds most classes is never
    gathered. What later steps read of a class is joined once and then carried,
    the signature only where the node may branch.
    """
    step = TOKENS // trees
    roots = F.array(*[F.xxhash64(F.lit(t), F.element_at("sig", t * step + 1)) for t in range(trees)])
    rows = classes.select("doc", F.posexplode(roots).alias("tree", "key"))
    done = None
    for level in range(1, FIRST_LEVELS + 1):
        sizes = rows.groupBy(F.col("key").alias("_k")).agg(F.count("*").alias("_n")).filter("_n > 1")
        sized = rows.join(sizes, F.col("key") == F.col("_k"))
        if level == 1:
            sized = sized.join(classes.select("doc", "n_shingles", "bytes", "sig"), "doc")
        most = SMALL if level < FIRST_LEVELS else LARGE
        sized = written(sized.select("key", "tree", "doc", F.col("_n").alias("n"), "n_shingles", "bytes", F.when(F.col("_n") > most, F.col("sig")).alias("sig")))
        leaves = sized if level == FIRST_LEVELS else sized.filter(F.col("n") <= SMALL)
        done = leaves if done is None else done.union(leaves)
        if level < FIRST_LEVELS:
            rows = written(_children(sized.filter(F.col("n") > SMALL)).drop("n"), PLAIN_ROWS)
    return done


def _runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key)
        if held and keys[-1] == held[0].column(key)[0]:  # the run goes on
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch], batch.schema)
        keys = table.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _forest(count: int, pairs: Iterable[tuple[int, int]]) -> tuple[list[int], list[tuple[int, int]]]:
    """Root of each of ``count`` items, and the pairs that joined two trees."""
    parent, used = list(range(count)), []
    for a, b in pairs:
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[max(a, b)] = min(a, b)
            used.append((a, b))
    for k in range(count):
        parent[k] = parent[parent[k]]
    return parent, used


def tokens_to_agree(percent: int) -> int:
    """Equal tokens from which a pair may have the given similarity (38 of 64 at 85 percent)."""
    share = percent / 100
    return max(1, int(TOKENS * share - SLACK * (TOKENS * share * (1 - share)) ** 0.5))


def similar_groups(leaves: DataFrame, agree: int) -> DataFrame:
    """``cell, tree, doc``: groups of classes of small leaves that at least ``agree`` equal tokens connect, each group once, of its first tree."""

    def group(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs((b for b in batches if b.num_rows), "key"):
            keys = table.column("key").to_numpy()
            names, tree = table.column("doc").to_pylist(), table.column("tree").to_pylist()
            sig = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(len(keys), -1)
            left, right = [], []
            for d in range(1, SMALL):
                at = np.flatnonzero(keys[d:] == keys[:-d])
                if not len(at):
                    break
                at = at[(sig[at] == sig[at + d]).sum(axis=1) >= agree]
                left += at.tolist()
                right += (at + d).tolist()
            root, _ = _forest(len(keys), zip(left, right))
            members: dict[int, list[bytes]] = {}
            trees: dict[int, int] = {}
            for k in sorted({*left, *right}):
                top = k
                while root[top] != top:
                    top = root[top]
                members.setdefault(top, []).append(names[k])
                trees[top] = tree[k]
            groups = [sorted(m) for m in members.values()]
            arrays = [pa.array([b"".join(m) for m in groups], pa.binary()), pa.array(list(trees.values()), pa.int32()), pa.array(groups, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["all", "tree", "docs"])

    dealt = leaves.select("key", "tree", "doc", "bytes").repartition("key").sortWithinPartitions("key")
    made = dealt.mapInArrow(group, "all binary, tree int, docs array<binary>").select(F.md5("all").alias("cell"), "tree", "docs")
    return made.groupBy("cell").agg(F.min("tree").alias("tree"), F.first("docs").alias("docs")).select("cell", "tree", F.explode("docs").alias("doc"))


def _blocks_needed(shingles: F.Column, count: F.Column) -> F.Column:
    """Blocks for so many classes with so many shingles in all."""
    return F.greatest(F.ceil(shingles / BLOCK_SHINGLES), F.ceil(count / BLOCK_CLASSES))


def chunks(members: DataFrame, heads: DataFrame) -> DataFrame:
    """``cell, doc``: ``members`` of larger leaves dealt to their leaf's ``chunks``, with the leaf's ``heads`` in each. Both are ``key, doc, chunks``."""
    dealt = members.select("key", "doc", F.pmod(F.xxhash64("doc", "key"), F.col("chunks")).alias("_mine"))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("_mine")
    both = dealt.union(heads.select("key", "doc", each)).distinct()
    return both.select(F.md5(F.concat_ws(":", "key", "_mine").cast("binary")).alias("cell"), "doc")


def leaders(members: DataFrame) -> DataFrame:
    """``key, label, doc``: the smallest class of each of a few parts of a leaf's label, mostly the same in all leaves that hold it."""
    part = F.pmod(F.xxhash64("doc", F.lit("leader")), F.lit(LEADERS))
    return members.groupBy("key", "label", part.alias("_part")).agg(F.min("doc").alias("doc")).select("key", "label", "doc")


def named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the label of each class; a class without one is its own."""
    return rows.drop("label").join(labels, "doc", "left").withColumn("label", F.coalesce("label", F.xxhash64("doc")))


def open_cells(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """``cell, doc``: the rows of those cells whose classes have several labels."""
    told = named(cells, labels)
    several = told.groupBy(F.col("cell").alias("_c")).agg(F.min("label").alias("_l"), F.max("label").alias("_h")).filter("_l <> _h").select("_c")
    return told.join(several, F.col("cell") == F.col("_c"), "left_semi").select("cell", "doc")


MEMBER = ("key", "doc", "n_shingles", "bytes", "label")


def open_nodes(members: DataFrame) -> DataFrame:
    """``_k, _most, n, others, chunks``: the nodes with several labels, the label of most members, how many members
    there are, how many of other labels, and the chunks that those need."""
    sized = members.groupBy("key", "label").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight"))
    most = F.max(F.struct("members", "label", "weight")).alias("most")
    nodes = sized.groupBy(F.col("key").alias("_k")).agg(F.count("*").alias("labels"), F.sum("members").alias("n"), F.sum("weight").alias("w"), most)
    others = F.col("n") - F.col("most.members")
    needed = _blocks_needed(F.col("w") - F.col("most.weight"), others)
    return nodes.filter("labels > 1").select("_k", F.col("most.label").alias("_most"), "n", others.alias("others"), needed.alias("chunks"))


def lower_leaves(members: DataFrame) -> DataFrame | None:
    """``MEMBER`` of the leaves below nodes of more than ``LARGE`` classes.

    A node whose classes are connected by now ends there, so a group of copies
    does not multiply on its way through the levels.
    """
    done = None
    for level in range(FIRST_LEVELS, LEVELS + 1):
        if members.isEmpty():
            break
        nodes = written(open_nodes(members).select("_k", "n"))
        members = written(members.join(nodes, F.col("key") == F.col("_k")).select(*MEMBER, "sig", "n"))
        leaves = (members if level == LEVELS else members.filter(F.col("n") <= LARGE)).select(*MEMBER)
        done = leaves if done is None else done.union(leaves)
        members = _children(members.filter(F.col("n") > LARGE).drop("n"))
    return done


def _parts(found: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """``found`` cut into parts of at most ``BLOCK_CLASSES`` classes and about ``BLOCK_SHINGLES`` shingles."""
    number = np.maximum(np.cumsum(weight[found]) // BLOCK_SHINGLES, np.arange(len(found)) // BLOCK_CLASSES)
    return np.split(found, np.flatnonzero(np.diff(number)) + 1)


def outsiders(members: DataFrame, nodes: DataFrame, agree: int) -> DataFrame:
    """``cell, doc``: classes of the open leaves ``nodes`` that agree in ``agree`` tokens with one of another label.

    Of any two labels one is not the leaf's largest, so only members outside
    the largest meet all members, ``BLOCK_SIGNED`` against as many at once. Two
    classes that share several leaves meet in the one with the smallest key
    only. Classes that agree, directly or through others, share cells of bounded
    size.
    """
    told = members.join(nodes, F.col("key") == F.col("_k")).withColumn("out", F.col("label") != F.col("_most"))
    told = written(told.select(*MEMBER, "out", "n", "others"), PLAIN_ROWS)
    keys = told.groupBy("doc").agg(F.collect_list("key").alias("keys"))  # leaves of a class: as many as the trees allow
    told = told.join(keys, "doc").withColumn("keys", F.filter("keys", lambda k: k < F.col("key")))
    told = told.withColumn("_few", F.ceil(F.col("others") / BLOCK_SIGNED)).withColumn("_all", F.ceil(F.col("n") / BLOCK_SIGNED))

    def cells(left: bool) -> F.Column:
        mine, others = ("_few", "_all") if left else ("_all", "_few")
        own = F.pmod(F.xxhash64("doc", F.lit(mine)), F.col(mine))

        def cell(other: F.Column) -> F.Column:
            name = F.concat_ws(":", "key", own, other) if left else F.concat_ws(":", "key", other, own)
            return F.struct(name.alias("cell"), F.lit(left).alias("left"))

        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1), cell)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs((b for b in batches if b.num_rows), "cell"):
            cell, names = table.column("cell").to_pylist(), table.column("doc").to_pylist()
            label, weight = table.column("label").to_numpy(), table.column("n_shingles").to_numpy()
            sig = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8).reshape(len(cell), -1)
            left = np.array(table.column("left").to_pylist(), bool)
            earlier = table.column("keys").combine_chunks()
            flat, upto = earlier.flatten().to_numpy(), np.cumsum([0, *pc.list_value_length(earlier).to_pylist()])
            edges = [0, *(k for k in range(1, len(cell)) if cell[k] != cell[k - 1]), len(cell)]
            for start, stop in zip(edges, edges[1:]):
                count, length = stop - start, np.diff(upto[start : stop + 1])
                # the earlier leaves of each class, by number; the last number is no leaf
                kinds, which = np.unique(flat[upto[start] : upto[stop]], return_inverse=True)
                places = np.full((count, int(length.max(initial=0)) + 1), len(kinds))
                places[np.repeat(np.arange(count), length), np.arange(len(which)) - np.repeat(upto[start:stop] - upto[start], length)] = which
                right = np.flatnonzero(~left[start:stop])
                group = np.arange(count)  # rows that agree, directly or through others
                there = np.zeros(count, bool)
                for k in np.flatnonzero(left[start:stop]).tolist():
                    partner = right[(label[start + right] != label[start + k]) & ((sig[start + right] == sig[start + k]).sum(axis=1) >= agree)]
                    mine = np.zeros(len(kinds) + 1, bool)
                    mine[places[k]] = True
                    mine[-1] = False
                    partner = partner[~mine[places[partner]].any(axis=1)]  # not met before
                    if len(partner):
                        there[partner] = there[k] = True
                        joined = np.zeros(count, bool)
                        joined[group[partner]] = joined[group[k]] = True
                        group[joined[group]] = group[k]
                made_cells, made = [], []
                for top in np.unique(group[there]).tolist():
                    own = np.flatnonzero(there & (group == top))
                    sides = [own[left[start + own]], own[~left[start + own]]]
                    one = _parts(own, weight[start : stop])
                    pairs = [(one[0],)] if len(one) == 1 else [(a, b) for a in _parts(sides[0], weight[start:stop]) for b in _parts(sides[1], weight[start:stop])]
                    for number, pair in enumerate(pairs):
                        found = sorted({names[start + k] for part in pair for k in part.tolist()})
                        made_cells += [f"{cell[start]}:{top}:{number}"] * len(found)
                        made += found
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(made_cells), pa.array(made, pa.binary())], names=["cell", "doc"])

    def rows(left: bool) -> DataFrame:
        own = told.filter("out") if left else told
        return own.select("doc", "label", "n_shingles", "bytes", "keys", F.explode(cells(left)).alias("_at")).select(F.md5(F.col("_at.cell").cast("binary")).alias("cell"), "_at.left", "doc", "label", "n_shingles", "bytes", "keys")

    both = rows(True).union(rows(False)).repartition("cell").sortWithinPartitions("cell")
    return both.mapInArrow(meet, "cell string, doc binary")


def true_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with at least ``percent`` of their union in common."""
    sizes = np.array([len(s) for s in sets], np.int64)
    shingle, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = count[column] > 1  # a shingle of one set is in no intersection
    row, column = row[shared], column[shared]
    used, column = np.unique(column, return_inverse=True)
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, len(used), COLUMNS):
        part = (column >= start) & (column < start + COLUMNS)
        there = np.zeros((len(sets), min(COLUMNS, len(used) - start)), np.float32)
        there[row[part], column[part] - start] = 1
        common += there @ there.T
    label, links = np.arange(len(sets)), []
    for start in range(0, len(sets), STRIP):
        overlap = common[start : start + STRIP].astype(np.int64)
        linked = 100 * overlap >= percent * (sizes[start : start + STRIP, None] + sizes[None, :] - overlap)
        for k in range(len(linked)):
            a = start + k
            others = np.flatnonzero(linked[k, a + 1 :]) + a + 1
            _, first = np.unique(label[others], return_index=True)  # one link to each tree met
            for b in others[first].tolist():
                if label[b] != label[a]:
                    links.append((a, b))
                    label[label == label[b]] = label[a]
    return links


def confirmed(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each class that full sets connect with others of its cell, and the smallest of those."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs((b for b in batches if b.num_rows), "cell"):
            cell = table.column("cell").to_pylist()
            names = table.column("doc").to_pylist()
            shingles = [x.values.to_numpy() for chunk in table.column("shingles").chunks for x in chunk]
            edges = [0, *(k for k in range(1, len(cell)) if cell[k] != cell[k - 1]), len(cell)]
            members, roots = [], []
            for start, stop in zip(edges, edges[1:]):
                # in the order of names, so that the root of a tree is its smallest class
                order = sorted(range(start, stop), key=names.__getitem__)
                root, _ = _forest(len(order), true_links([shingles[k] for k in order], percent))
                for k in range(len(order)):
                    top = k
                    while root[top] != top:
                        top = root[top]
                    if top != k:
                        members.append(names[order[k]])
                        roots.append(names[order[top]])
            if members:
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary()), pa.array(roots, pa.binary())], names=["a", "b"])

    dealt = cells.join(sets, "doc").select("cell", "doc", "shingles").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(compare, "a binary, b binary")


def connected(classes: DataFrame, only: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, component``: the component of each class that is linked with another one."""
    agree = tokens_to_agree(percent)
    leaves = leaves_of_trees(classes)
    groups = written(similar_groups(leaves.filter(F.col("n") <= SMALL), agree), PLAIN_ROWS)
    large = leaves.filter(F.col("n") > SMALL)
    involved = groups.select("doc").union(large.select("doc")).distinct()
    sets = written(_full_sets(only, classes.join(involved, "doc", "left_semi").select("doc", "least"), size), SET_ROWS)

    one = large.filter("tree = 0").select("key", "doc", "n_shingles", F.lit(0).alias("label"))
    needed = one.groupBy(F.col("key").alias("_k")).agg(_blocks_needed(F.sum("n_shingles"), F.count("*")).alias("chunks"))
    first = chunks(one.join(needed, F.col("key") == F.col("_k")), leaders(one).join(needed, F.col("key") == F.col("_k")))
    links = written(confirmed(groups.filter("tree = 0").select("cell", "doc").union(first), sets, percent).distinct(), SET_ROWS)
    # equal labels are connected; that connected classes may have different ones only costs work
    labels = links.union(links.select("b", "b")).groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("b"))
    labels = written(labels.select("doc", F.xxhash64("b").alias("label")))
    small = open_cells(groups.filter("tree > 0").select("cell", "doc"), labels)
    members = written(named(large.filter(F.col("n") <= LARGE), labels).select(*MEMBER))
    lower = lower_leaves(named(large.filter(F.col("n") > LARGE), labels).select(*MEMBER, "sig"))
    members = members if lower is None else members.union(lower)
    nodes = written(open_nodes(members))
    outside = members.join(nodes, (F.col("key") == F.col("_k")) & (F.col("label") != F.col("_most")))
    heads = leaders(members).join(nodes, (F.col("key") == F.col("_k")) & (F.col("label") == F.col("_most")))
    second = small.union(chunks(outside, heads))
    links = links.union(written(confirmed(second, sets, percent).distinct(), SET_ROWS))
    component = components_of(links)

    labels = component.select(F.col("node").alias("doc"), F.xxhash64("component").alias("label"))
    members = written(named(members, labels).select(*MEMBER))
    nodes = written(open_nodes(members))
    if not nodes.isEmpty():
        cells = written(outsiders(members, nodes, agree), PLAIN_ROWS)
        last = written(confirmed(cells, sets, percent).distinct(), SET_ROWS)
        if not last.isEmpty():
            component = components_of(links.union(last))
    return component


def components_of(links: DataFrame) -> DataFrame:
    """Components of the classes that links connect."""
    return connected_components(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), links)


def near_copies(docs: DataFrame, size: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row, linked at ``percent`` similarity of ``size``-word shingle sets."""
    only = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    signed = written(signatures(only, size))
    filled = signed.filter("cls IS NOT NULL")
    classes = written(
        filled.groupBy(F.col("cls").alias("doc")).agg(F.min("id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("bytes").alias("bytes"))
    )
    component = connected(classes, only, size, percent)

    ids = component.join(classes.select(F.col("doc").alias("node"), "least"), "node")
    least = ids.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = ids.join(least, "component").select(F.col("node").alias("doc"), "component_id")
    of_class = classes.select("doc", "least").join(by_class, "doc", "left").select(F.col("doc").alias("cls"), F.coalesce("component_id", "least").alias("component_id"))
    rows = signed.select("id", "n_shingles", "cls").join(of_class, "cls", "left")
    component_id = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", component_id.alias("component_id"), F.col("id").eqNullSafe(component_id).alias("kept"))


def _full_sets(only: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``doc, shingles`` of the wanted classes, from the text of one document of each."""
    one = wanted.select("doc", F.col("least").alias("_least"))

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in blocks(batches, "_text"):
            found = {}  # other texts may have the same id
            for name, own in zip(part.column("doc").to_pylist(), shingle_sets(Words(texts, lower=True), size)):
                if set_class(own) == name:
                    found[name] = own.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["doc", "shingles"])

    return only.join(one, only["_id"].eqNullSafe(one["_least"])).select("doc", "_text").mapInArrow(fill, "doc binary, shingles array<bigint>")


def one_of_each(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``.

    The row with the group's smallest id stays. Rows with equal ids are told
    apart by a number given when the rows are first written; of several rows
    with the smallest id the first stays. Rows without words are in no group,
    and rows whose group has no id at all keep one of them.
    """
    numbered = written(docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("number")))
    # the row number is the id of the join, so that every row is a node of its own
    links = near_copies(numbered.select("number", F.col("row.text").alias("text")), size, percent, id_col="number")
    groups = links.select(F.col("doc_id").alias("node"), F.col("component_id").alias("group"), (F.col("n_shingles") > 0).alias("filled"))
    placed = written(numbered.select("number", "id").join(groups, F.col("number") == F.col("node")).select("number", "id", "group", "filled"))
    # smallest id first; a null id last
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("d"), F.col("number").alias("r"))
    first = placed.filter("filled").groupBy("group").agg(F.min(order)["r"].alias("kept")).select("kept")
    kept = first.union(placed.filter("NOT filled").select("number"))
    return numbered.join(kept, F.col("number") == F.col("kept"), "left_semi").select("row.*")
