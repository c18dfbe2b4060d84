"""Documents whose sets of word n-grams are similar, found by rare-first prefix filtering.

Documents of equal words are one class, and a class is one set of n-grams. Two sets of Jaccard
similarity 0.8 share a fixed share of their n-grams, so in any order that all sets follow they share
one among the first few of each. The order is rare first, by the number of classes that hold an
n-gram. An n-gram that only one class holds comes first and joins nothing, so a set most of whose
n-grams are its own has no candidate at all. Three passes:

1. A third of all n-grams (by hash) is counted; classes too few of whose n-grams are shared to have a
   partner go.
2. All n-grams of the rest are counted. A set keeps its shared ones, in order; the number of its own
   is enough to know every place in the order and every size.
3. Sets meet under the n-grams of their prefixes. Length, positional and suffix filters leave
   candidates; each is measured once on whole sets.

Under an n-gram that many sets have in their prefix not all pairs are measured: in each round one
leader per n-gram is measured against the sets that are not in its component yet. An n-gram whose sets
are one component is done. What no leader took in is at last compared pair by pair, across components.
Under an n-gram of few sets all pairs are compared at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.memory import keep_only
from threadloom.llm.shared import MAX_BROADCAST_KEYS, cut, global_rank
from threadloom.llm.simhash import components, shingle_hashes

WORDS = 5
# Least similarity, as a fraction.
NUM, DEN = 4, 5
THIN = 3  # of the n-grams, one of so many is counted in the first pass
# N-grams of a part of the count (about), and those that a task packs at a time.
PART, SLICE = 1 << 20, 1 << 20
# Rounds of leaders end when so many pairs per prefix n-gram are left, or after so many.
PAIRS_A_ROW, MAX_ROUNDS = 2, 5
# Sets (of some 20 prefix rows each) that a task compares, where there are more than tasks for them.
SETS_A_TASK = 5_000
FEW = 32  # sets under an n-gram that are compared in pairs at once
SEED = 42
CLASSES = 4  # of the suffix filter, 16 bits each in a long
_LOW, _COUNTED = (1 << 48) - 1, (1 << 32) - 1
_MANY = (1 << 16) - 1  # of a suffix class: so many or more
PACKED = "part int, kind int, nodes binary, owners binary, tokens binary"
SHARED = "a bigint, b bigint, n bigint, lacking bigint, tokens binary, counts binary"
SETS = ("a bigint, b bigint, n bigint, tokens array<bigint>, "
        "keys array<struct<key: bigint, pos: int, behind: bigint>>")


def needed(n: int) -> int:
    """N-grams that a set of `n` shares with any partner, at least."""
    return (n * NUM + DEN - 1) // DEN


def words_of(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def class_of(words: bytes) -> tuple[int, int]:
    """128 bits of the words, as two longs."""
    digest = xxhash.xxh3_128_intdigest(words)
    high, low = digest >> 64, digest & ((1 << 64) - 1)
    return tuple(v - (1 << 64) if v >> 63 else v for v in (high, low))


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, row key, class and number of words of every row; a row without words has no class."""
    def run(batches):
        keep_only("n-gram classes")
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch.column("text")]
            keys = [class_of(w) if w else (None, None) for w in words]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("doc_id", "r", "s")),
                *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)),
                pa.array([w.count(b" ") + 1 if w else 0 for w in words], pa.int64())],
                ["doc_id", "r", "s", "a", "b", "n_words"])

    return docs.mapInArrow(
        run, "doc_id bigint, r bigint, s bigint, a bigint, b bigint, n_words bigint")


def row_key() -> list[Column]:
    """Two digests of a row's id and text, by which its text is found again."""
    return [F.xxhash64("doc_id", "text").alias("r"),
            F.xxhash64(F.lit(SEED), "text", "doc_id").alias("s")]


def texts_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts of the (r, s) of `rows`; these are broadcast only if they are counted as few."""
    rows = cut(rows.select("r", "s"))
    if rows.count() <= MAX_BROADCAST_KEYS:
        rows = F.broadcast(rows)
    return docs.join(rows, ["r", "s"], "left_semi").select("text")


# --- shared n-grams ---------------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2**48 in six bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def packed(texts: DataFrame, words: int, parts: int, thin: int, with_tokens: bool) -> DataFrame:
    """N-grams of `text` by part: first each one's count in a slice of texts, then its owners.

    N-gram h is number h // parts, of which 48 bits are kept, in part h % parts. It is counted by its
    lower 32 bits, so a few n-grams share a count, which only moves them in the order. Kind 0 has
    distinct counted numbers and counts, kind 1 numbers (counted ones without `with_tokens`) with
    the places of their owners among the row's classes, kind 2 classes, their sets' sizes, and how many of
    these n-grams are counted: with `thin` over 1, one of so many.
    """
    def rows_of(nodes: list, sets: list[np.ndarray]) -> Iterator[tuple]:
        ab = np.array(nodes, np.int64).reshape(-1, 2)
        sizes = np.fromiter(map(len, sets), "<u4", len(sets))
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        if thin > 1:
            chosen = (tokens >> np.uint64(40)) % np.uint64(thin) == 0
            tokens, owners = tokens[chosen], owners[chosen]
        counted = np.bincount(owners, minlength=len(sets)).astype("<u4")
        yield int(ab[0, 0] % parts), 2, ab.tobytes(), sizes.tobytes(), counted.tobytes()
        part, number = tokens % np.uint64(parts), tokens // np.uint64(parts) & np.uint64(_LOW)
        order = np.lexsort((number, part))
        part, number, owners = part[order], number[order], owners[order]
        borders = np.flatnonzero(np.diff(part)) + 1
        for p, values, own in zip(part[np.append(0, borders)] if len(part) else (),
                                  np.split(number, borders), np.split(owners, borders)):
            distinct, counts = np.unique(values & np.uint64(_COUNTED), return_counts=True)
            yield int(p), 0, b"", counts.astype("<u4").tobytes() if counts.max() > 1 else b"", \
                distinct.astype("<u4").tobytes()
            held, place = np.unique(own, return_inverse=True)
            yield int(p), 1, ab[held].tobytes(), place.astype("<u2").tobytes(), (
                _pack(values) if with_tokens else (values & np.uint64(_COUNTED)).astype("<u4").tobytes())

    def batch_of(nodes, sets):
        columns = zip(*rows_of(nodes, sets), strict=True)
        types = pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["part", "kind", "nodes", "owners", "tokens"])

    def run(batches):
        keep_only("n-grams")
        nodes, sets, held = [], [], 0
        for batch in batches:
            for text in batch.column("text"):
                found = np.unique(shingle_hashes(text.as_py(), words))
                if not len(found):
                    continue
                nodes.append(class_of(words_of(text.as_py())))
                sets.append(found)
                held += len(found)
                if held >= SLICE or len(sets) == 1 << 16:
                    yield batch_of(nodes, sets)
                    nodes, sets, held = [], [], 0
        if sets:
            yield batch_of(nodes, sets)

    return texts.select("text").mapInArrow(run, PACKED)


def shared_tokens(packed_rows: DataFrame, parts: int, with_tokens: bool) -> DataFrame:
    """Per class and part: its n-grams that more than one class holds, or its size.

    `lacking` adds up, over a class, to the number of its counted n-grams that no other class holds.

    A part's counts come before its owners, so a task holds the distinct n-grams of one part, and
    goes through their owners row by row, however many an n-gram has.
    """
    def owned(part: int, nodes: bytes, owners: bytes, tokens: bytes, known, counts) -> Iterator:
        own = np.frombuffer(owners, "<u2")
        numbers = _unpack(tokens) if with_tokens else np.frombuffer(tokens, "<u4")
        counted = (numbers & numbers.dtype.type(_COUNTED)).astype(np.uint32)
        at = np.minimum(np.searchsorted(known, counted), len(known) - 1)
        hit = np.flatnonzero(known[at] == counted) if len(known) else np.zeros(0, int)
        hit = hit[np.argsort(own[hit], kind="stable")]
        ab = np.frombuffer(nodes, np.int64).reshape(-1, 2).tolist()
        borders = np.flatnonzero(np.diff(own[hit])) + 1
        for group in np.split(hit, borders) if len(hit) else ():
            a, b = ab[own[group[0]]]
            yield (a, b, None, -len(group)) + ((
                (numbers[group] * np.uint64(parts) + np.uint64(part)).astype("<u8").tobytes(),
                counts[at[group]].astype("<u4").tobytes()) if with_tokens else (None, None))

    def sizes(nodes: bytes, owners: bytes, counted: bytes) -> Iterator:
        ab = np.frombuffer(nodes, np.int64).reshape(-1, 2).tolist()
        for (a, b), n, m in zip(ab, np.frombuffer(owners, "<u4").tolist(),
                                np.frombuffer(counted, "<u4").tolist(), strict=True):
            yield a, b, n, m, None, None

    def merged(lists: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        numbers = [np.frombuffer(t, "<u4") for t, _ in lists]
        weights = [np.frombuffer(c, "<u4") if c else np.ones(len(v), np.uint32)
                   for v, (_, c) in zip(numbers, lists, strict=True)]
        distinct, inverse = np.unique(np.concatenate(numbers), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(weights), len(distinct)).astype(np.int64)
        return distinct[counts > 1], np.minimum(counts[counts > 1], (1 << 32) - 1)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()
        columns = zip(*rows, strict=True) if rows else [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["a", "b", "n", "lacking", "tokens", "counts"])

    def run(batches):
        keep_only("shared n-grams")
        now, lists, known, counts = None, [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            rows = []
            for part, kind, nodes, owners, tokens in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    now, lists, known = part, [], None
                if kind == 0:
                    lists.append((tokens, owners))
                elif kind == 1:
                    if known is None:
                        known, counts = merged(lists)
                        lists = []
                    rows += owned(part, nodes, owners, tokens, known, counts)
                else:
                    rows += sizes(nodes, owners, tokens)
            yield out(rows)

    return packed_rows.repartitionById(parts, "part").sortWithinPartitions(
        "part", "kind").mapInArrow(run, SHARED)


def sets_of(shared: DataFrame) -> DataFrame:
    """Per class that can have a partner: size, shared n-grams rare first, and its prefix n-grams.

    `pos` is a prefix n-gram's place among all of the set's, and `behind` the number of shared ones
    after it in each of four hash classes, 16 bits each.
    """
    gathered = shared.groupBy("a", "b").agg(
        F.max("n").alias("n"), F.collect_list(F.struct("tokens", "counts")).alias("found"))

    def read(n: int, found: list[dict]):
        found = [f for f in found if f["tokens"] is not None]
        tokens = np.frombuffer(b"".join(f["tokens"] for f in found), "<u8").astype(np.int64)
        counts = np.frombuffer(b"".join(f["counts"] for f in found), "<u4")
        tokens, first = np.unique(tokens, return_index=True)  # a repeated row sends them again
        if len(tokens) < needed(n):
            return None
        tokens = tokens[np.lexsort((tokens, counts[first]))]
        own, prefix = n - len(tokens), n - needed(n) + 1
        kinds = (tokens >> 8) % CLASSES
        after = np.stack([np.cumsum((kinds == k)[::-1])[::-1] for k in range(CLASSES)], axis=1)
        after = np.concatenate([after[1:], np.zeros((1, CLASSES), after.dtype)])
        after = np.minimum(after, _MANY).astype("<u2").view("<i8")[:, 0]
        keys = [{"key": t, "pos": own + i, "behind": int(after[i])}
                for i, t in enumerate(tokens[:max(0, prefix - own)].tolist())]
        return tokens, keys

    def run(batches):
        keep_only("n-gram sets")
        for batch in batches:
            rows = []
            for a, b, n, found in zip(batch.column("a"), batch.column("b"),
                                      batch.column("n").to_pylist(), batch.column("found")):
                one = read(n, found.as_py())
                if one is not None:
                    rows.append((a.as_py(), b.as_py(), n, *one))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            key = pa.struct([("key", pa.int64()), ("pos", pa.int32()), ("behind", pa.int64())])
            types = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["a", "b", "n", "tokens", "keys"])

    return gathered.mapInArrow(run, SETS)


# --- candidates -------------------------------------------------------------------------------

def _possible(x: str, y: str) -> Column:
    """Length, positional and suffix filter for two sets under their first common n-gram."""
    def of(side, name):
        return F.col(f"{side}.{name}")

    n, m = of(x, "n"), of(y, "n")
    least = F.ceil((n + m) * NUM / (NUM + DEN)).cast("bigint")
    behind = F.lit(1)
    for shift in range(0, 64, 16):
        both = F.least(*[F.shiftrightunsigned(of(side, "behind"), shift).bitwiseAND(F.lit(_MANY))
                         for side in (x, y)])
        behind += F.when(both == _MANY, F.least(n, m)).otherwise(both)
    return ((F.least(n, m) * DEN >= F.greatest(n, m) * NUM)
            & (F.least(n - of(x, "pos"), m - of(y, "pos")) >= least) & (behind >= least))


def _pairs(x: DataFrame, y: DataFrame, how: Column) -> DataFrame:
    """Distinct pairs that may be similar, and their components."""
    return x.alias("x").join(y.alias("y"), "key").where(
        how & (F.col("x.root") != F.col("y.root")) & _possible("x", "y")).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"),
        F.when(F.col("x.node") < F.col("y.node"), F.col("x.root")).otherwise(
            F.col("y.root")).alias("root_a"),
        F.when(F.col("x.node") < F.col("y.node"), F.col("y.root")).otherwise(
            F.col("x.root")).alias("root_b")).distinct()


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, of the pairs that are similar."""
    def side(name):
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"{name}_n"),
                           F.col("tokens").alias(f"{name}_tokens"))

    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return pairs.join(side("b"), "b").join(side("a"), "a").where(
        both * (NUM + DEN) >= (F.col("a_n") + F.col("b_n")) * NUM).select(
        F.col("root_a").alias("a"), F.col("root_b").alias("b"))


def _hooked(roots: DataFrame, new: DataFrame) -> DataFrame:
    """`roots` (node, root) with each root hooked to the least within two of the links `new`.

    That merges what a leader links; what longer paths link is merged in the end.
    """
    both = new.unionByName(new.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("b"), F.least("a", "m").alias("m"))
    least = both.join(near, "b").groupBy("a").agg(F.min("m").alias("m")).select(
        F.col("a").alias("root"), F.least("a", "m").alias("_new"))
    return roots.join(least, "root", "left").select("node", F.coalesce("_new", "root").alias("root"))


def set_components(sets: DataFrame, max_rounds: int = MAX_ROUNDS, pairs_a_row: int = PAIRS_A_ROW,
                   few: int = FEW) -> DataFrame:
    """`node` and `root`, the least node of its component, for all `sets` that are not least.

    Up to `few` sets under an n-gram are compared in pairs at once. The others are rounds of leaders;
    rows stay dealt by n-gram, and only the small table of roots is renewed in each round.
    """
    many = sets.count()
    bounded = many <= MAX_BROADCAST_KEYS
    tasks = max(sets.sparkSession.sparkContext.defaultParallelism, -(-many // SETS_A_TASK))

    def kept(rows: DataFrame) -> DataFrame:
        """As `cut`, in as many tasks as the sets need: what follows a shuffle here is small."""
        return cut(rows.coalesce(tasks))

    keyed = sets.select("node", "n", F.inline("keys"))
    held = keyed.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
    keyed = kept(keyed.join(held, "key"))
    roots = sets.select("node", F.col("node").alias("root"))

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(roots) if bounded else roots, "node")

    pairs_of = F.col("x.node") < F.col("y.node")
    small = keyed.where(F.col("sets") <= few).withColumn("root", F.col("node"))
    edges = kept(_links(kept(_pairs(small, small, pairs_of)), sets).distinct())
    roots = kept(_merged_roots(roots, edges, tasks))
    live = kept(keyed.where(F.col("sets") > few).drop("sets"))
    rows = live.count()
    for turn in range(max_rounds + 1):
        now = rooted(live)
        per_key = now.groupBy("key", "root").agg(F.count("*").alias("k")).groupBy("key").agg(
            F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("same"))
        # an n-gram whose sets are all in one component is done
        left = kept(per_key.where("all * all > same"))
        pending = left.agg(F.sum((F.col("all") * F.col("all") - F.col("same")) / 2)).first()[0] or 0
        if not pending:
            break
        now = now.join(left.select("key"), "key")
        last = pending <= pairs_a_row * rows or turn == max_rounds
        if last:
            pairs = _pairs(now, now, pairs_of)
        else:
            order = F.struct(F.xxhash64("node", F.lit(turn)).alias("_order"),
                             "node", "n", "pos", "behind", "root")
            leaders = now.groupBy("key").agg(F.min(order).alias("lead")).select("key", "lead.*")
            pairs = _pairs(leaders, now, F.lit(True))
        new = kept(_links(kept(pairs), sets).distinct())
        edges = edges.unionByName(new)
        if last:
            break
        roots = kept(_hooked(roots, new))
    return components(edges, tasks)


def _merged_roots(roots: DataFrame, edges: DataFrame, tasks: int) -> DataFrame:
    """`roots` after whole components of `edges`."""
    found = components(edges, tasks).withColumnRenamed("root", "_new")
    return roots.join(found, "node", "left").select("node", F.coalesce("_new", "root").alias("root"))


def similar_documents(docs: DataFrame, words: int = WORDS, thin: int = THIN,
                      part: int = PART) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_shingles and component_id, the least doc_id linked to it.

    Documents are linked if the sets of their n-grams of `words` words (of fewer words, all of them as
    one) have a Jaccard similarity of at least 0.8. A null, empty or blank text has no n-gram, is
    linked with nothing, and is its own component. Rows may repeat; a null doc_id keeps its row and
    names a component only where no other id does. An empty table gives no rows. N-grams are told
    apart by over 48 bits of their hash, texts by 128.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    docs = docs.select("doc_id", "text", *row_key())
    rows = cut(prints(docs))
    classes = cut(rows.where("n_words > 0").groupBy("a", "b").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("r", "s")).alias("row"),
        F.first("n_words").alias("n_words")))
    total = classes.agg(F.sum("n_words")).first()[0] or 0
    parts = max(1, -(-total // thin // part))
    sizes = cut(shared_tokens(
        packed(texts_of(docs, classes.select("row.*")), words, parts, thin, False), parts, False
    ).groupBy("a", "b").agg(F.max("n").alias("n"), F.sum("lacking").alias("lacking")))
    # a set shares all but so many of its n-grams with a partner, and so of any part of them
    alone = F.col("n") - F.ceil(F.col("n") * NUM / DEN)
    left = cut(classes.join(sizes.where(F.col("lacking") <= alone), ["a", "b"]).select("row.*", "n"))
    parts = max(1, -(-(left.agg(F.sum("n")).first()[0] or 0) // part))
    sets = global_rank(sets_of(shared_tokens(
        packed(texts_of(docs, left), words, parts, 1, True), parts, True)), "a", "b"
    ).withColumnRenamed("rank", "node").drop("total")
    roots = set_components(sets)
    linked = sets.select("a", "b", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")).join(classes.select("a", "b", "least"), ["a", "b"])
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = cut(linked.join(named, "root").select("a", "b", "component_id"))
    member = classes.select("a", "b", "least").join(sizes.select("a", "b", "n"), ["a", "b"]).join(
        linked, ["a", "b"], "left").select(
        "a", "b", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "least").alias("component_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    without = rows.where("n_words = 0").select(
        "doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n_words > 0").join(member, ["a", "b"]).select(*columns).unionByName(without)
