"""Near-duplicate documents by Order MinHash and banded alignment.

Five-word shingles, labelled with their occurrence number, are hashed by 64 functions; each function picks
the two least and keeps them in text order. Documents that share such a pick, and whose lengths allow it,
are candidates. Texts of up to 14 words also meet by what is left of them without as many words as the
threshold lets differ, so no pair of these is missed; longer ones are missed with the chance that the README
gives. A candidate pair is linked if the edit similarity of the word sequences (1 - distance /
longer length, found by a bit-parallel alignment within the band that the threshold leaves) is 0.8 or more.
Links are closed to classes.

Equal word sequences are one node from the start, so copies cost one row each. Inside a bucket every
member is compared with a hub, then with two more; members that are joined by links already are not
compared, so a large group of near copies costs about its size. Buckets that still hold several components
are compared whole, in blocks: a task gets the words of two blocks and gives links only, so every pair of a
bucket is linked, compared or joined by other links, and no pair is a row. No link between candidates is lost.

Words are runs of letters, digits and underscores in lower case. A text of under five words is one
shingle; texts without words (null and empty ones too) are equal to each other. Nodes are known by 64 bits
of a 128-bit hash of their words. A row with a null doc_id takes part; class_id is the least doc_id of the
class, null if it has none. Repeated rows are in one class. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free, returned, slices
from marquee.session import checkpointed, small

SHINGLE = 5
PICKED = 2
SKETCHES = 64
SHORT_WORDS = 14
SIMILARITY = 0.8
MOST_HUBS = 2
WORD = re.compile(r"\w+")
KEPT_WORDS = 300_000


def word_list(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


@functools.lru_cache(maxsize=1)
def _constants() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2019)
    odd = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd(SHINGLE), odd(SKETCHES), odd(SKETCHES)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads close numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def labelled_shingles(hashes: np.ndarray) -> np.ndarray:
    """Hash of each shingle with the number of its earlier occurrences, in text order."""
    factors = _constants()[0]
    n = max(1, len(hashes) - SHINGLE + 1)
    found = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(hashes))):
        found += _mixed(hashes[i : i + n] * factors[i])
    found = _mixed(found)
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    if not fresh.all():
        place = np.arange(n)
        label = np.empty(n, np.uint64)
        label[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
        found = np.where(label > 0, _mixed(found + label), found)
    return found


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One number per hash function: its least shingles, in text order."""
    _, factors, salts = _constants()
    if len(shingles) > PICKED:
        where = np.empty((SKETCHES, PICKED), np.int64)
        for at in range(0, SKETCHES, 16):  # so many functions at once, as texts can be long
            cut = slice(at, at + 16)
            ranks = (shingles[None, :] ^ salts[cut, None]) * factors[cut, None]
            rows = np.arange(len(ranks))
            for j in range(PICKED):
                where[cut, j] = found = ranks.argmin(axis=1)
                ranks[rows, found] = np.iinfo(np.uint64).max
        picked = shingles[np.sort(where, axis=1)]
    else:
        picked = np.tile(shingles, (SKETCHES, 1))
    out = salts.copy()
    for j in range(picked.shape[1]):
        out = _mixed(out * np.uint64(3) + picked[:, j])
    return out


def short_keys(hashes: np.ndarray) -> list[int]:
    """Of a text of up to `SHORT_WORDS` words, one number for each way to leave out as many words as may differ.

    Two texts within the threshold have a common part that either gives by leaving out words, so they share a key.
    """
    import xxhash

    n = len(hashes)
    if not 0 < n <= SHORT_WORDS:
        return []
    parts = {tuple(hashes.tolist())}
    for _ in range(int((1 - SIMILARITY) * n + 1e-9)):
        parts |= {p[:i] + p[i + 1 :] for p in parts for i in range(len(p))}
    return sorted(xxhash.xxh3_64_intdigest(np.array(p, np.uint64).tobytes()) for p in parts)


@returned
def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    known = _Words()
    for batch in slices(batches, 512):
        nodes, seconds, sizes, found = [], [], [], []
        for text in batch.column(2).to_pylist():
            words = word_list(text)
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            whole = xxhash.xxh3_128_digest(hashes.tobytes())
            nodes.append(int.from_bytes(whole[:8], "little", signed=True))
            seconds.append(int.from_bytes(whole[8:], "little", signed=True))
            sizes.append(len(words))
            picks = sketch(labelled_shingles(hashes)) if words else np.zeros(SKETCHES, np.uint64)
            found.append(np.r_[picks, np.array(short_keys(hashes), np.uint64)])
        flat = np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(seconds, pa.int64()),
             pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["doc_id", "tie", "node", "second", "n_words", "sketch"],
        )


def bag_distance(a: Counter, b: Counter) -> int:
    """A lower bound of the edit distance: words of one text that the other lacks."""
    return max(sum((a - b).values()), sum((b - a).values()))


def banded_distance(long: list, short: list, most: int) -> int | None:
    """Edit distance if it is at most `most`, else None.

    Bit-parallel alignment of a band: bit k of a column stands for the row on the k-th diagonal of the band of
    2 * most + 1 diagonals, so the band moves down one row with each column. First the distance is followed
    along the lowest diagonal, then, below the last row, along that row.
    """
    if len(long) < len(short):
        long, short = short, long
    head = 0
    while head < len(short) and long[head] == short[head]:
        head += 1
    tail = 0
    while tail < len(short) - head and long[-1 - tail] == short[-1 - tail]:
        tail += 1
    long, short = long[head : len(long) - tail], short[head : len(short) - tail]
    if len(long) - len(short) > most:
        return None
    if not short or most == 0:
        return len(long) if len(long) <= most else None
    most = min(most, len(long))
    width = 2 * most + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    rows: dict = {}
    for i, word in enumerate(long):
        rows[word] = rows.get(word, 0) | (1 << i)
    up, down = full ^ ((1 << most) - 1), 0
    distance, give_up = most, 2 * most + len(short) - len(long)
    edge = top >> 1
    for j, word in enumerate(short):
        same = rows.get(word, 0)
        shift = j - most
        same = ((same >> shift) if shift >= 0 else (same << -shift)) & full
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right = down | (full & ~(diagonal | up))
        left = diagonal & up
        if j < len(long) - most:
            distance += not diagonal & top
        else:
            distance += bool(right & edge) - bool(left & edge)
            edge >>= 1
        if distance > give_up and j < len(long) - most:
            return None
        moved = diagonal >> 1
        up = left | (full & ~(moved | right))
        down = moved & right
    return distance if distance <= most else None


def similarity(a: list[str], b: list[str], least: float = SIMILARITY) -> float | None:
    """Edit similarity of two word lists if it is at least `least`, else None."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int((1 - least) * longer + 1e-9)
    if abs(len(a) - len(b)) > most or bag_distance(Counter(a), Counter(b)) > most:
        return None
    found = banded_distance(a, b, most)
    return None if found is None else 1 - found / longer


@returned
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, words = None, []
    for batch in slices(batches, 512):
        out = []
        for a, b, text, hub_text in zip(*[c.to_pylist() for c in batch.columns]):
            if b != last:
                last, words = b, word_list(hub_text)
            found = similarity(word_list(text), words)
            if found is not None:
                out.append((a, b, found))
        a, b, s = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["a", "b", "similarity"])


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that alignment confirms."""
    left = pairs.join(texts.select(F.col("node").alias("a"), "text"), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("hub_text")), "b")
    return both.select("a", "b", "text", "hub_text").mapInArrow(_verify, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """node -> root (least node) for the nodes of `edges` (a, b).

    Every node moves to its least neighbour; the edges are moved along and shrink until none is left.
    """
    roots = None
    while edges.take(1):
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")))
        step = parent.select(F.col("a").alias("root"), "to")
        if roots is None:
            roots = parent.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            roots = checkpointed(roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        pa_, pb_ = parent.select("a", F.col("to").alias("ta")), parent.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(pa_, "a").join(pb_, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        chains = parent.select(F.col("to").alias("a")).distinct().join(pa_, "a").select("a", F.col("ta").alias("b"))
        edges = checkpointed(moved.unionByName(chains).where("a != b").distinct())
    return roots


def _with_roots(df: DataFrame, roots: DataFrame | None, node: str, root: str) -> DataFrame:
    if roots is None:
        return df.withColumn(root, F.col(node))
    named = roots.select(F.col("node").alias(node), F.col("root").alias("_r"))
    return df.join(named, node, "left").withColumn(root, F.coalesce("_r", node)).drop("_r")


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs whose nodes are not joined yet."""
    if roots is None:
        return pairs
    return _with_roots(_with_roots(pairs, roots, "a", "_ra"), roots, "b", "_rb").where("_ra != _rb").drop("_ra", "_rb")


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Roots after adding links."""
    if not links.take(1):
        return roots
    moved = _with_roots(_with_roots(links.select("a", "b"), roots, "a", "_ra"), roots, "b", "_rb")
    new = components(checkpointed(moved.select(F.col("_ra").alias("a"), F.col("_rb").alias("b")).where("a != b").distinct()))
    if new is None:
        return roots
    if roots is None:
        return new
    further = new.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    old = roots.join(further, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    added = new.join(roots.select("node"), "node", "left_anti")
    return checkpointed(old.unionByName(added))


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, turn, node, n_words): picks that several nodes share; the keys of short texts have turn -1."""
    turn = F.when(F.col("place") < SKETCHES, F.col("place")).otherwise(F.lit(-1)).alias("turn")
    picks = nodes.select("node", "n_words", F.posexplode("sketch").alias("place", "pick")).select("node", "n_words", turn, "pick").select(
        F.xxhash64("turn", "pick").alias("bucket"), "turn", "node", "n_words"
    )
    several = picks.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket")
    return checkpointed(picks.join(several, "bucket", "left_semi"))


def _meetings(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """(node, hub) of each bucket whose lengths allow the threshold, but pairs that are joined already; two hubs
    meet once."""
    fits = F.least("n_words", "_n") >= SIMILARITY * F.greatest("n_words", "_n") - 1e-9
    if "_root" not in members.columns:
        return members.join(hubs.select("bucket", "hub", "_n"), "bucket").where((F.col("node") != F.col("hub")) & fits)
    met = members.select("bucket", "node", "n_words", "_root", "weight").join(hubs.select("bucket", "hub", "_n", "_hub_root", F.col("weight").alias("_w")), "bucket")
    later = F.struct("weight", "_root", "node") > F.struct("_w", "_hub_root", "hub")
    return met.where((F.col("_root") != F.col("_hub_root")) & later & fits)


# --- buckets that hold several components after the first hubs ------------------------------------------------

BLOCK = 512
PROFILE = "node long, words binary, sketch binary"
PACKED = "bucket long, block int, turn int, nodes array<long>, roots array<long>, words array<binary>, sketches array<binary>"


@returned
def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words as 32-bit numbers, and the sketch. Different words with one number can only bring texts closer."""
    known = _Words()
    for batch in slices(batches, 512):
        words, found = [], []
        for text in batch.column(1).to_pylist():
            hashes = np.fromiter(map(known.__getitem__, word_list(text)), np.uint64)
            words.append((hashes >> np.uint64(32)).astype("<u4").tobytes())
            found.append(sketch(labelled_shingles(hashes)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(words, pa.binary()), pa.array(found, pa.binary())], names=["node", "words", "sketch"]
        )


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, block) to one row per block; one block is held at a time."""
    names = ("bucket", "block", "turn", "node", "_root", "words", "sketch")

    def rows():
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in names])

    kinds = [pa.int64(), *[pa.int32()] * 2, *[pa.list_(pa.int64())] * 2, *[pa.list_(pa.binary())] * 2]
    columns = [f.split(" ")[0] for f in PACKED.split(", ")]
    out, held = [], 0
    for _, group in itertools.groupby(rows(), key=lambda r: r[:2]):
        members = list(group)
        out.append((*members[0][:3], *[list(c) for c in zip(*[m[3:] for m in members])]))
        held += len(members)
        if held >= 4 * BLOCK:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=columns)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=columns)


def _spread_counts(words: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount(words & np.uint32(2047), minlength=2048), 255).astype(np.int16)


@returned
def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components that two blocks of a bucket hold.

    A pair is looked at only in the first bucket its nodes share (and in those of short texts), not if its nodes are joined by the links of
    this task, and aligned only if its word counts allow the threshold.
    """
    for batch in slices(batches, 1):
        row = {n: batch.column(n)[0].as_py() for n in batch.schema.names}
        sides = []
        for s in ("", "_2"):
            words = [np.frombuffer(w, "<u4") for w in row[f"words{s}"]]
            sides.append({
                "node": row[f"nodes{s}"], "root": row[f"roots{s}"], "words": words,
                "n": np.array([len(w) for w in words]), "counts": np.array([_spread_counts(w) for w in words]),
                "sketch": np.array([np.frombuffer(k, np.uint64) for k in row[f"sketches{s}"]]),
            })
        a, b = sides
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while joined.get(x, x) != x:
                x = joined[x]
            return x

        out, lists, same = [], {}, row["block"] == row["block_2"]
        roots_b = np.array(b["root"])
        for i, node in enumerate(a["node"]):
            equal = b["sketch"] == a["sketch"][i]
            most = ((1 - SIMILARITY) * np.maximum(a["n"][i], b["n"]) + 1e-9).astype(int)
            fits = equal[:, row["turn"]] & (equal.argmax(axis=1) == row["turn"]) if row["turn"] >= 0 else np.ones(len(equal), bool)
            fits &= (np.abs(a["n"][i] - b["n"]) <= most) & (roots_b != a["root"][i])
            if same:
                fits[: i + 1] = False
            for j in np.flatnonzero(fits).tolist():
                if find(a["root"][i]) == find(b["root"][j]):
                    continue
                apart = a["counts"][i] - b["counts"][j]
                if max(int(apart[apart > 0].sum()), -int(apart[apart < 0].sum())) > most[j]:
                    continue
                left = lists.setdefault(node, a["words"][i].tolist())
                right = lists.setdefault(b["node"][j], b["words"][j].tolist())
                if bag_distance(Counter(left), Counter(right)) <= most[j] and banded_distance(left, right, int(most[j])) is not None:
                    joined[find(a["root"][i])] = find(b["root"][j])
                    out.append((max(node, b["node"][j]), min(node, b["node"][j])))
        x, y = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])


def block_links(members: DataFrame, roots: DataFrame | None, texts: DataFrame) -> DataFrame:
    """(a, b): links that join the components a bucket still holds, without a row per pair.

    Buckets are dealt in blocks of about 512 nodes, and every two blocks of a bucket are compared at once. The join
    is of blocks, so a large bucket is many rows, which adaptive execution splits over tasks.
    """
    needed = texts.join(members.select("node").distinct(), "node", "left_semi")
    profiles = needed.select("node", "text").mapInArrow(_profiles, PROFILE)
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = (
        _with_roots(members, roots, "node", "_root").join(sizes, "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(17)), F.col("blocks")).cast("int"))
        .join(profiles, "node")
        .select("bucket", "block", "turn", "node", "_root", "words", "sketch")
    )
    packed = checkpointed(dealt.repartition("bucket", "block").sortWithinPartitions("bucket", "block").mapInArrow(_packs, PACKED))
    other = packed.drop("turn")
    other = other.select("bucket", *[F.col(c).alias(f"{c}_2") for c in other.columns if c != "bucket"])
    both = packed.join(other, "bucket").where("block <= block_2")
    return both.mapInArrow(_compare_blocks, "a long, b long").distinct()


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), n_words, class_id, class_tie: the first document of the class."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    sketched = checkpointed(rows.mapInArrow(_sketches, "doc_id long, tie long, node long, second long, n_words long, sketch array<long>"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie"))
    nodes = sketched.groupBy("node").agg(first.alias("first"), F.max("n_words").alias("n_words"))
    own = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie")
    nodes = checkpointed(nodes)
    representatives = sketched.join(nodes.where("n_words > 0").select("node", "first"), "node").where(own == F.col("first"))
    representatives = representatives.select("node", "n_words", "sketch").dropDuplicates(["node"])
    members = _members(representatives)
    active = checkpointed(
        nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.tie").alias("tie"))
    )
    wanted = small(active).alias("w")
    r = rows.alias("r")
    texts = checkpointed(
        r.join(wanted, F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("r.tie") == F.col("w.tie"))).select("w.node", "r.text").dropDuplicates(["node"])
    )
    roots, tested, hubs = None, None, 1
    while members.take(1):
        if hubs == 1:
            chosen = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.min_by("n_words", "node").alias("_n"))
            weighed = members
        else:
            # nodes of the bucket's small components first: they meet the large ones, whose nodes need not meet each other
            rooted = _with_roots(members, roots, "node", "_root")
            sizes = rooted.groupBy("bucket", "_root").agg(F.count(F.lit(1)).alias("weight"))
            weighed = checkpointed(rooted.join(sizes, ["bucket", "_root"]))
            rank = F.row_number().over(Window.partitionBy("bucket").orderBy("weight", "_root", "node"))
            chosen = weighed.withColumn("_rank", rank).where(F.col("_rank") <= hubs).select("bucket", F.col("node").alias("hub"), F.col("n_words").alias("_n"), "weight", F.col("_root").alias("_hub_root"))
        pairs = (
            _meetings(weighed, chosen).groupBy(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b"))
            .agg(F.count(F.lit(1)).alias("votes"))
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = checkpointed(_apart(pairs, roots))
        if hubs == 1:  # most are linked with the hub they meet most often
            best = pairs.groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))
            best = checkpointed(best)
            roots = _merged(roots, checkpointed(linked(best, texts)))
            pairs = checkpointed(_apart(pairs.join(best, ["a", "b"], "left_anti"), roots))
            roots = _merged(roots, checkpointed(linked(pairs.select("a", "b"), texts)))
            seen = best.unionByName(pairs.select("a", "b"))
        else:
            roots = _merged(roots, checkpointed(linked(pairs.select("a", "b"), texts)))
            seen = pairs.select("a", "b")
        tested = checkpointed(seen if tested is None else tested.unionByName(seen))
        rooted = _with_roots(members, roots, "node", "_root")
        mixed = rooted.groupBy("bucket").agg(F.min("_root").alias("lo"), F.max("_root").alias("hi")).where("lo != hi").select("bucket")
        open_ = members.join(mixed, "bucket", "left_semi")  # the others are one component each
        members = checkpointed(open_.join(chosen.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti"))
        hubs *= 2
        if hubs > MOST_HUBS:
            if members.take(1):
                found = checkpointed(block_links(members, roots, texts))
                roots = _merged(roots, checkpointed(linked(found, texts)))
            break
    classes = _with_roots(nodes.select("node", "first"), roots, "node", "root")
    least = classes.groupBy("root").agg(F.min("first").alias("head"))
    named = classes.join(least, "root").select("node", "head.doc_id", "head.tie").toDF("node", "class_id", "class_tie")
    return sketched.select("doc_id", "tie", "node", "n_words").join(named, "node").select("doc_id", "tie", "n_words", "class_id", "class_tie")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document row of each class stays: the least doc_id, of equal ones the least text hash. All its
    columns stay as they are."""
    heads = near_classes(docs).where("doc_id <=> class_id and tie = class_tie").select("doc_id", "tie").distinct().alias("h")
    (own,) = free(docs, "_tie")
    d = docs.withColumn(own, F.xxhash64("text")).alias("d")
    kept = d.join(heads, F.col("d.doc_id").cast("long").eqNullSafe(F.col("h.doc_id")) & (F.col(f"d.{own}") == F.col("h.tie")), "left_semi")
    return kept.dropDuplicates(["doc_id", own]).select(*[F.col(f"`{c}`") for c in docs.columns])
