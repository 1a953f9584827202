"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint has one or more 64-bit words.  The index keeps, for each leading block of bits, the distinct
fingerprints sorted by the Gray rank of the block.  Upper nodes are the runs that share a masked bit pattern; the
topmost pattern is the shuffle key, so Spark deals the upper nodes out, and lower nodes are built inside a task.  A
pair of nodes is followed down only while the differences added up so far stay within the radius, so whole groups
are pruned.  With blocks that partition the fingerprint, two fingerprints at ``radius`` < number of blocks agree in
one block: the search is exact.  With a larger radius it finds candidates, with a recall that follows from the number
of blocks, and ``drop_near_copies`` links only those whose shingle sets have the wanted Jaccard similarity: the sets of a
candidate component are compared with each other, in parts of about ``PART`` sets.

A node with more fingerprints than ``NODE_CAP`` is cut into chunks and every pair of chunks becomes a task of its
own, so nothing is dropped and no task holds more than two chunks.  A task returns a spanning forest of its
links, never all pairs.

Null and empty texts have the fingerprint zero, linked like any other; null ids never become a component's id unless
all ids are null; repeated rows share their fingerprint; an empty table gives an empty table; extra columns are
ignored by ``near_components`` and kept by ``drop_near_copies``.
"""

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from ..session import settle
from .components import components
from .text import lowered_words, row_key

NODE_CAP = 4096
PAIRS_AT_ONCE = 500_000
#: Shingle sets and characters of a part of a candidate component.
PART, PART_CHARS = 512, 1 << 23
MASK = (1 << 64) - 1


class Scheme:
    """How texts become fingerprints and how they are compared.

    ``blocks`` are (first bit, width) of the leading blocks, ``radius`` the greatest number of differing bits.  With
    ``least``, a fraction (numerator, denominator), fingerprints are of shingle sets and only find candidates; sets are
    linked from that Jaccard similarity on; candidates of any of ``families`` fingerprints, independent of each other, count.
    """

    def __init__(self, shingle, words, blocks, radius, least=None, families=1):
        self.shingle, self.words, self.blocks, self.radius, self.least, self.families = shingle, words, blocks, radius, least, families
        self.columns = [f"f{i}" for i in range(words * families)]


#: 64 bits over three-word shingles, links at two bits or fewer; three blocks make the search exact.
STRICT = Scheme(3, 1, [(0, 22), (22, 21), (43, 21)], 2)
#: Twice 256 bits over sets of five-word shingles, linked at Jaccard similarity 0.8.  Sets of that similarity differ in 15 % of
#: the bits on average (39 of 256, deviation 6) and share none of 32 blocks of 8 bits in one of 20,000 cases, so none in both families
#: in one of 400 million.
SIMILAR = Scheme(5, 4, [(8 * i, 8) for i in range(32)], 72, (4, 5), families=2)


def shingle_hashes(text, shingle):
    """XXH64 (seed 42) of every run of ``shingle`` words, repeats included; fewer words: of the whole sequence."""
    w = lowered_words(text)
    if not w:
        return np.zeros(0, np.uint64)
    runs = [w] if len(w) < shingle else zip(*(w[i:] for i in range(shingle)))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.array([digest(join(r), 42) for r in runs], np.uint64)


def lane_table():
    """For a byte a number with each of its bits, highest first, in a byte of its own."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
    return np.ascontiguousarray(bits).view("<u8").ravel()


def majority(hashes, lanes):
    """64-bit word whose bit is 1 where more than half of the hashes have it."""
    n = len(hashes)
    if n == 0:
        return 0
    spread = lanes[hashes.astype(">u8").view(np.uint8).reshape(n, 8)]
    part = np.add.reduceat(spread, np.arange(0, n, 255), axis=0)
    counts = part.view(np.uint8).reshape(len(part), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def remix(hashes, number):
    """The hashes as another family: number 0 leaves them as they are."""
    if number == 0:
        return hashes
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * number & MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_fingerprint(docs: DataFrame, scheme: Scheme, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the words of the fingerprint as long columns ``<prefix>f0``, ``<prefix>f1`` ..."""
    shingle, words = scheme.shingle, len(scheme.columns)

    @pandas_udf(T.ArrayType(T.LongType()))
    def fingerprint(batch: pd.Series) -> pd.Series:
        lanes, out = lane_table(), []
        for t in batch:
            h = shingle_hashes(t, shingle)
            out.append(np.array([majority(remix(h, i), lanes) for i in range(words)], np.uint64).view(np.int64))
        return pd.Series(out, dtype=object)

    made = docs.withColumn(f"{prefix}_fp", fingerprint(F.col(f"`{text}`")))
    return made.select("*", *[F.col(f"{prefix}_fp")[i].alias(f"{prefix}f{i}") for i in range(words)]).drop(f"{prefix}_fp")


def with_shingle_set(docs: DataFrame, scheme: Scheme, text: str = "text") -> DataFrame:
    """``docs`` with the fingerprint and ``set``, a 128-bit digest that names the text's set of shingles."""
    shingle, words = scheme.shingle, len(scheme.columns)

    @pandas_udf("fp array<long>, name binary")
    def fingerprint(batch: pd.Series) -> pd.DataFrame:
        lanes, prints, names = lane_table(), [], []
        for t in batch:
            h = np.unique(shingle_hashes(t, shingle))
            prints.append(np.array([majority(remix(h, i), lanes) for i in range(words)], np.uint64).view(np.int64))
            names.append(xxhash.xxh3_128_digest(h.tobytes()))
        return pd.DataFrame({"fp": prints, "name": names})

    made = docs.withColumn("_set", fingerprint(F.col(f"`{text}`")))
    return made.select("*", *[F.col("_set.fp")[i].alias(c) for i, c in enumerate(scheme.columns)], F.col("_set.name").alias("set")).drop("_set")


def block_values(columns, first, width):
    """The bits [first, first + width) of fingerprints given as arrays of uint64 words."""
    word, at = divmod(first, 64)
    left = columns[word] << np.uint64(at)
    if at + width > 64:
        left = left | (columns[word + 1] >> np.uint64(64 - at))
    return left >> np.uint64(64 - width)


def gray_rank(values):
    """Position of a bit pattern in Gray order."""
    x = values.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def forest(found_a, found_b, parent):
    """Join the classes of linked elements in ``parent`` (every element's smallest known member)."""
    while len(found_a):
        a, b = parent[found_a], parent[found_b]
        open_ = a != b
        if not open_.any():
            return
        found_a, found_b, a, b = found_a[open_], found_b[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def linked_classes(columns, block, radius):
    """For fingerprints of one upper node (arrays of uint64 words): the smallest index each is linked with.

    Only pairs that agree in ``block`` are looked at.  The order, and with it the tree, is by Gray rank of the block
    and then of the words.
    """
    lead = block_values(columns, *block)
    order = np.lexsort([gray_rank(c) for c in columns[::-1]] + [gray_rank(lead)])
    words = [c[order] for c in columns]
    lead, m = lead[order], len(order)
    heads, change = [np.zeros(1, np.int64)], np.zeros(m, bool)
    change[0] = True
    if radius >= 16:
        # So wide a radius prunes no lower node: the words of a run are compared in blocks of rows.
        parent = np.arange(m)
        change[1:] = lead[1:] != lead[:-1]
        begins = np.flatnonzero(change)
        for low, high in zip(begins.tolist(), [*begins[1:].tolist(), m]):
            step = max(1, PAIRS_AT_ONCE // (high - low))
            for at in range(low, high, step):
                upto = min(high, at + step)
                differ = sum(np.bitwise_count(w[at:upto, None] ^ w[None, low:upto]).astype(np.uint16) for w in words)
                a, b = np.nonzero(differ <= radius)
                a, b = a + at, b + low
                forest(a[b < a], b[b < a], parent)
        out = np.empty(m, np.int64)
        out[order] = order[parent]
        return out
    # Levels of the tree: the block itself, then segments of the words; a node is a run with one masked pattern.
    segments = [(lead, 0)] + [((w << np.uint64(s)) >> np.uint64(56), radius) for w in words for s in range(0, 64, 8)]
    for values, _ in segments:
        change[1:] |= values[1:] != values[:-1]
        heads.append(np.flatnonzero(change))
    parent = np.arange(m)

    def descend(a, b, differ, level):
        """Pairs of nodes (a <= b) of a level with the differences of their patterns so far."""
        if level == len(segments):
            forest(a, b, parent)
            return
        first, below = np.searchsorted(heads[level + 1], heads[level]), len(heads[level + 1])
        size = np.diff(np.append(first, below))
        upto = np.cumsum(size[a] * size[b])
        for low in range(0, int(upto[-1]), PAIRS_AT_ONCE):
            # Pairs of children number low and up, also where one pair of nodes has more than fit at once.
            k = np.arange(low, min(low + PAIRS_AT_ONCE, int(upto[-1])))
            pair = np.searchsorted(upto, k, side="right")
            k = k - (upto[pair] - size[a[pair]] * size[b[pair]])
            p, q = first[a[pair]] + k // size[b[pair]], first[b[pair]] + k % size[b[pair]]
            fresh = p <= q
            p, q, pair = p[fresh], q[fresh], pair[fresh]
            values, most = segments[level]
            v = values[heads[level + 1]]
            d = np.bitwise_count(v[p] ^ v[q]).astype(np.int64)
            total = d + (0 if level == 0 else differ[pair])
            ok = total <= most
            if ok.any():
                descend(p[ok], q[ok], total[ok], level + 1)

    descend(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64), 0)
    out = np.empty(m, np.int64)
    out[order] = order[parent]
    return out


def fingerprint_links(prints: DataFrame, scheme: Scheme, n: int) -> DataFrame:
    """Links (a, b) between the keys ``k`` of distinct fingerprints; ``n`` is about their number.

    The links of a node are given as a spanning forest.
    """
    radius, blocks, columns = scheme.radius, scheme.blocks, [f"w{i}" for i in range(scheme.words)]
    top = max(0, math.ceil(math.log2(max(1, n) / (NODE_CAP / 2))))

    def upper(first, width):
        p = min(top, width)
        if p == 0:
            return F.lit(0).cast("long")
        word, at = divmod(first, 64)
        left = F.shiftleft(F.col(columns[word]), at)
        if at + p > 64:
            left = left.bitwiseOR(F.shiftrightunsigned(F.col(columns[word + 1]), 64 - at))
        return F.shiftrightunsigned(left, 64 - p)

    nodes = None
    for family in range(scheme.families):
        words = [F.col(f"f{family * scheme.words + i}").alias(c) for i, c in enumerate(columns)]
        own = prints.select("k", *words).select("k", *columns, F.posexplode(F.array(*[upper(*b) for b in blocks])).alias("block", "node"))
        own = own.withColumn("block", F.col("block") + family * len(blocks))
        nodes = own if nodes is None else nodes.unionByName(own)
    sizes = settle(nodes.groupBy("block", "node").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    chunks = F.ceil(F.col("n") / NODE_CAP)
    # The table of sizes has 2^top nodes of each block; it is written, so Spark broadcasts it where it is small.
    routed = (nodes.join(sizes, ["block", "node"])
              .withColumn("own", F.pmod(F.xxhash64("k"), chunks))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
              .select("block", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "k", *columns))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k")
        words = [pdf[c].to_numpy(np.int64).view(np.uint64) for c in columns]
        to = linked_classes(words, blocks[pdf["block"].iloc[0] % len(blocks)], radius)
        k = pdf["k"].to_numpy()
        on = np.flatnonzero(to != np.arange(len(k)))
        return pd.DataFrame({"a": k[on], "b": k[to[on]]})

    return routed.groupBy("block", "node", "i", "j").applyInPandas(link, "a long, b long")


def class_roots(rows: DataFrame, scheme: Scheme, by: str) -> DataFrame:
    """(fingerprint columns, ``root_by``): for every distinct fingerprint the smallest ``by`` of its component.

    ``rows`` is a written table with the fingerprint columns.
    """
    columns = scheme.columns
    prints = rows.groupBy(*columns).agg(F.min(by).alias("least_by"))
    prints = settle(prints.select(*columns, "least_by", F.monotonically_increasing_id().alias("k")), "prints")
    links = settle(fingerprint_links(prints, scheme, prints.count()), "found")
    roots = components(links)
    joined = settle(prints.join(roots, prints.k == roots.node, "left").select(*columns, "least_by", F.coalesce("root", "k").alias("root")), "roots")
    least = joined.groupBy("root").agg(F.min("least_by").alias("root_by"))
    return joined.join(least, "root").select(*columns, "root_by")


def near_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scheme: Scheme = STRICT) -> DataFrame:
    """One row per document: doc_id, fingerprint columns f0.., component_id (smallest doc_id of its component)."""
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = settle(with_fingerprint(plain, scheme).drop("text"), "fingerprints")
    roots = class_roots(rows, scheme, "doc_id")
    same = [F.col(f"r.{c}") == F.col(f"c.{c}") for c in scheme.columns]
    return rows.alias("r").join(roots.alias("c"), same).select("r.*", F.col("c.root_by").alias("component_id"))


def exact_classes(sets, least):
    """For sets given as arrays of distinct hashes: the smallest index each is linked with.

    Links are pairs of Jaccard similarity ``least`` (numerator, denominator) or more, from exact counts of shared hashes.
    """
    n, (num, den) = len(sets), least
    size, parent = np.array([len(x) for x in sets], np.int64), np.arange(len(sets))
    owner, flat = np.repeat(np.arange(n), size), np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    change = np.append(True, flat[order][1:] != flat[order][:-1])[:len(flat)]
    begins = np.flatnonzero(change)
    run, token = np.diff(np.append(begins, len(flat))), np.empty(len(flat), np.int64)
    token[order] = np.cumsum(change) - 1
    owners, first = owner[order], np.cumsum(size) - size
    a, b = [], []
    for i in range(n):
        # All owners of the set's hashes: the places of the runs, one after the other.
        t = token[first[i]:first[i] + size[i]]
        t = t[run[t] > 1]
        ends = np.cumsum(run[t])
        if len(t):
            shared = np.bincount(owners[np.arange(ends[-1]) + np.repeat(begins[t] - ends + run[t], run[t])], minlength=n)[:i]
            on = np.flatnonzero((shared > 0) & (den * shared >= num * (size[i] + size[:i] - shared)))
            a.append(np.full(len(on), i))
            b.append(on)
    if a:
        forest(np.concatenate(a), np.concatenate(b), parent)
    return parent


def exact_links(members: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b), a spanning forest, of the sets ``k`` of a candidate component ``root`` that are similar enough.

    ``members`` is a written table of k, root and a text of the set.  The parts of a component are searched one by one,
    then one set of each class found; where that leaves several classes, every set outside the largest one is compared
    with all sets of its component.  So pairs are left out only where both sets are in one class already.
    """
    shingle, least = scheme.shingle, scheme.least

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("k").sort_values("k")
        to, k = exact_classes([np.unique(shingle_hashes(t, shingle)) for t in pdf["text"]], least), pdf["k"].to_numpy()
        on = np.flatnonzero(to != np.arange(len(k)))
        return pd.DataFrame({"a": k[on], "b": k[to[on]]})

    def parts(rows, number, name):
        n = rows.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / PART), F.ceil(F.sum(F.length("text")) / PART_CHARS)).alias(number))
        return rows.join(settle(n, "parts"), "root").withColumn(name, F.pmod(F.xxhash64("k"), F.col(number)))

    def classes(rows, links):
        return rows.join(components(links).select(F.col("node").alias("k"), F.col("root").alias("_class")), "k", "left").withColumn("class", F.coalesce("_class", "k")).drop("_class")

    def found(rows, *by):
        return settle(rows.groupBy("root", *by).applyInPandas(compare, "a long, b long"), "links")

    members = parts(members.withColumn("text", F.coalesce("text", F.lit(""))), "parts", "part")
    links = found(members.select("root", "part", "k", "text"), "part")
    wide = settle(members.where("parts > 1"), "wide")
    if wide.limit(1).count() == 0:
        return links
    heads = classes(wide, links).where("k = class").select("root", "k", "text")
    links = links.union(found(parts(heads, "n", "part").select("root", "part", "k", "text"), "part"))
    split = settle(classes(wide, links), "classes")
    size = settle(split.groupBy("root", "class").agg(F.count("*").alias("n")), "sizes")
    largest = size.groupBy("root").agg(F.max(F.struct("n", "class")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
    split = split.join(settle(largest.select("root", F.col("top.class").alias("top")), "largest"), "root")
    rest = parts(split.where("class != top"), "others", "other")
    others = settle(rest.select("root", "others").distinct(), "others")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows = (split.join(others, "root").withColumn("other", upto("others")).select("root", "part", "other", "k", "text")
            .union(rest.withColumn("part", upto("parts")).select("root", "part", "other", "k", "text")))
    return links.union(found(rows, "part", "other"))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scheme: Scheme = SIMILAR) -> DataFrame:
    """The documents with the smallest id of each component, with their own columns.

    Rows that are equal in all columns count as one; of others with one id one stays; a null id comes last.
    """
    id_ = F.col(f"`{doc_id}`")
    plain = docs.select(id_.alias("id"), row_key(docs).alias("key"), F.col(f"`{text}`").alias("text"))
    rows = settle(with_shingle_set(plain, scheme).drop("text"), "fingerprints")
    by = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    sets = rows.groupBy("set", *scheme.columns).agg(F.min(by).alias("by"))
    sets = settle(sets.select(*scheme.columns, "by", F.monotonically_increasing_id().alias("k")), "prints")
    near = components(settle(fingerprint_links(sets, scheme, sets.count()), "found"))
    near = settle(near.join(sets, near.node == sets.k).select("k", near.root, F.col("by.key").alias("key")), "candidates")
    members = settle(plain.select("key", "text").join(near, "key").dropDuplicates(["k"]).select("k", "root", "text"), "members")
    roots = components(exact_links(members, scheme))
    stay = (sets.join(roots, sets.k == roots.node, "left").groupBy(F.coalesce("root", "k").alias("root"))
            .agg(F.min("by").alias("by")).select(F.col("by.key").alias("_key")).distinct())
    return docs.withColumn("_key", row_key(docs)).join(stay, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
