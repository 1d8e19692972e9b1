"""N-gram Jaccard join: extended prefixes, single rare tokens and combinations of frequent ones, then exact checks, as link classes.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Documents with equal sets are one node. Two nodes link at
a Jaccard similarity of PERCENT / 100 or more, so each holds all but a fifth of its shingles in common with the other.

1. Every node indexes an extended prefix: the fifth of its shingles that may be missing in a partner, and
   a tenth more, in hash order. Linked nodes then share at least that tenth, so a node with fewer indexed
   shingles in common with anyone has no link. Shingles held by one node only never leave the index.
2. Lists of copies are resolved by contraction instead of all their pairs: each member is verified against the list's
   first node, linked nodes become one class, and lists within one class are done. In rare shingles' lists (up to
   RARE nodes) the pairs of different classes are verified if they can share enough of the prefix.
3. A pair left over shares frequent shingles only, so its nodes have more of them than may be missing. Those nodes are
   contracted again over their whole sets; then their rare-first prefixes are indexed, rare shingles singly and frequent ones
   in combinations of two (see combinations), and the pairs that meet are verified.

No step caps partners or candidates: every pair that could link is verified or is in one class already. Class ids come
from min-label propagation with pointer jumping over verified links.

Defined cases: null, empty and wordless texts have no set, link with nothing and are their own component; a text under
five words is one shingle; repeated rows are equal sets; a null doc_id never names a class (a class of such rows only has
a null component) but its row links and bridges like any other; an empty table gives an empty result; extra columns
pass through one_of_each, whatever their names; texts of any length are hashed in bounded segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.base import bound_batches, discard, map_batches, materialize, table, trim
from touchline.llm.kernels import mix, shingles, words

#: Links in one task's union-find.
WIDTH, PERCENT, RARE, STARS, PART = 5, 80, 16, 2, 500_000
#: Rows of two or three numbers that are broadcast, after a count.
BROADCAST_ROWS = 500_000


def missing(n):
    """How many shingles of a set of n a linked set may lack."""
    return n - -(-PERCENT * n // 100)


def node_id(tokens: np.ndarray) -> int:
    """A 63-bit fingerprint of a set."""
    total = np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total]))[0] >> np.uint64(1))


def document_sets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns with n (set size) and g (fingerprint, null for an empty set); only texts go to Python."""

    def run(texts: pa.Array) -> dict[str, pa.Array]:
        n, g = np.zeros(len(texts), np.int64), np.full(len(texts), -1, np.int64)
        for row, hashes in words(texts, lower=True):
            if len(hashes):
                s = shingles(hashes, WIDTH)
                n[row], g[row] = len(s), node_id(s)
        return {"n": pa.array(n), "g": pa.array(g, mask=g < 0)}

    return map_batches(docs, run, "n long, g long", keep, ["text"])


def prefix_postings(docs: DataFrame) -> DataFrame:
    """(token, g) of every text's extended prefix; equal sets of a batch are written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            tokens, nodes, held = [], [], 0
            for _, hashes in words(batch.column(0), lower=True):
                if not len(hashes):
                    continue
                s = shingles(hashes, WIDTH)
                g = node_id(s)
                if g in seen:
                    continue
                seen.add(g)
                part = s[: missing(len(s)) + 1 + len(s) // 10]
                tokens.append(part)
                nodes.append(np.full(len(part), g, np.int64))
                held += len(part)
                if held > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes))], names=["token", "g"])
                    tokens, nodes, held = [], [], 0
            trim()
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes))], names=["token", "g"])

    return bound_batches(docs).select("text").mapInArrow(run, "token long, g long")


def shared_lists(postings: DataFrame) -> DataFrame:
    """(token, g) of the tokens that at least two nodes hold, each once; a stream over sorted rows, so no list is held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_t = last_g = None
        pending = False  # the last row's token has one node so far
        for batch in batches:
            t, g = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(t):
                continue
            fresh = np.ones(len(t), bool)
            fresh[1:] = (t[1:] != t[:-1]) | (g[1:] != g[:-1])
            fresh[0] = last_t is None or t[0] != last_t or g[0] != last_g
            t, g = t[fresh], g[fresh]
            if not len(t):
                continue
            same_before = np.zeros(len(t), bool)
            same_before[1:] = t[1:] == t[:-1]
            same_before[0] = last_t is not None and t[0] == last_t
            same_after = np.zeros(len(t), bool)
            same_after[:-1] = same_before[1:]
            out_t, out_g = [], []
            if pending and same_before[0]:
                out_t.append(np.array([last_t], np.int64))
                out_g.append(np.array([last_g], np.int64))
            held = same_before | same_after
            pending = not held[-1]
            out_t.append(t[held])
            out_g.append(g[held])
            last_t, last_g = t[-1], g[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_t)), pa.array(np.concatenate(out_g))], names=["token", "g"])

    return postings.repartition("token").sortWithinPartitions("token", "g").mapInArrow(run, "token long, g long")


def set_table(texts: DataFrame) -> DataFrame:
    """(g, n, toks): the sorted 64-bit shingle hashes of the texts whose fingerprint is g."""

    def run(column: pa.Array, wanted: pa.Array) -> dict[str, pa.Array]:
        out: list[bytes | None] = [None] * len(column)
        for row, hashes in words(column, lower=True):
            s = shingles(hashes, WIDTH)
            if len(s) and node_id(s) == wanted[row].as_py():
                out[row] = s.astype("<u8").tobytes()
        return {"toks": pa.array(out, pa.binary())}

    return map_batches(texts, run, "toks binary", ["g", "n"], ["text", "g"]).where("toks is not null")


def _unpack(toks: bytes) -> np.ndarray:
    return np.frombuffer(toks, "<u8")


def only(rows: DataFrame, key: str, wanted: DataFrame, count: int) -> DataFrame:
    """rows joined with wanted (count rows, one a key) before they are shuffled, if wanted is small enough to go everywhere."""
    return rows.join(F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted, key)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of pairs (written) whose sets link. Rows of a hot node are split by Spark's skew handling of the joins."""
    named = materialize(pairs.select(F.explode(F.array("a", "b")).alias("g")).distinct(), "named")
    sets = only(sets, "g", named, named.count())
    right = sets.select(F.col("g").alias("b"), F.col("toks").alias("tb"))
    left = sets.select(F.col("g").alias("a"), F.col("toks").alias("ta"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            good = np.zeros(len(a), bool)
            known: tuple[bytes, np.ndarray] | None = None
            for i in range(len(a)):
                ta, tb = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if known is None or known[0] != ta:
                    known = (ta, _unpack(ta))
                x, y = known[1], _unpack(tb)
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                good[i] = 100 * common >= PERCENT * (len(x) + len(y) - common)
            trim()
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])

    return bound_batches(both).mapInArrow(run, "a long, b long")


def _forest(edges: DataFrame, parts: int) -> DataFrame:
    """(a, b): each part's edges become stars, its nodes pointing to the least node of their part's component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p] if p in parent else p
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        nodes = list(parent)
        for k in range(0, len(nodes), 100_000):
            own = nodes[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([root(x) for x in own], pa.int64())], names=["a", "b"])

    return edges.coalesce(parts).mapInArrow(run, "a long, b long")


def components(links: DataFrame, count: int) -> DataFrame:
    """(g, c): of every node in links (count rows, written) the least node of its component.

    Parts of about PART links become stars by union-find. Where that is more than one part, their stars are merged by
    min-label propagation with pointer jumping until nothing moves; each round is a few joins over the nodes in links.
    """
    parts = -(-count // PART)
    stars = materialize(_forest(links.select("a", "b"), parts), "forest")
    if parts <= 1:
        return stars.select(F.col("a").alias("g"), F.col("b").alias("c"))
    edges = materialize(stars.where("a <> b").union(stars.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = materialize(edges.groupBy(F.col("a").alias("g")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        by_edge = edges.join(label.withColumnRenamed("g", "b"), "b").groupBy(F.col("a").alias("g")).agg(F.min("c").alias("m"))
        spread = label.join(by_edge, "g").select("g", F.least("c", "m").alias("c"), F.col("c").alias("old"))
        jump = label.select(F.col("g").alias("c"), F.col("c").alias("cc"))
        new = materialize(spread.join(jump, "c").select("g", F.least("c", "cc").alias("c"), "old"), "labels")
        done = new.where("c <> old").limit(1).count() == 0
        label = new.select("g", "c")
        if done:
            return label


class Classes:
    """The class of each node that is known to link, and the sets to verify pairs with."""

    def __init__(self, spark: SparkSession, sets: DataFrame):
        self.sets, self.label, self.known = sets, spark.createDataFrame([], "g long, c long"), 0

    def add(self, pairs: DataFrame) -> int:
        """Verify pairs and merge the classes of those that link; returns their number."""
        found = materialize(verify(pairs, self.sets), "links")
        count = found.count()
        if count:
            # earlier links enter as one edge a node, to its class
            old = self.label.where("g <> c").select(F.col("g").alias("a"), F.col("c").alias("b"))
            self.label = components(old.unionByName(found), self.known + count)
            self.known += count
        return count

    def of(self, lists: DataFrame) -> DataFrame:
        """lists with c, the class of g."""
        return lists.join(self.label, "g", "left").withColumn("c", F.coalesce("c", "g"))

    def open_lists(self, lists: DataFrame, turn: int = 0) -> DataFrame:
        """(token, g, n, c, df, hub) of the lists that span two classes or more; the hub differs from turn to turn."""
        own = self.of(lists)
        # the node with most of its set in lists first: an original has no edits of its own; later turns pick among the like
        central = -F.col("w") if turn % 10 == 0 else -F.round("w", 1)
        hub = F.min(F.struct(central.alias("w"), F.xxhash64("g", F.lit(turn)).alias("h"), "g", "c")).alias("hub")
        wide = own.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("df"), hub).where("lo <> hi")
        return materialize(own.join(wide.select("token", "df", F.col("hub.g").alias("hub"), F.col("hub.c").alias("hub_c")), "token"), "open")

    def contract(self, lists: DataFrame, part: int, turns: int, seed: int) -> DataFrame:
        """Verify members against their lists' hubs, turn by turn while that finds links; returns the lists still open.

        lists: (token, g, n, w), w: the share of its set that a node has in lists at first.

        Only pairs that share at least n / part listed tokens are worth trying here; what is left open is for the exact step.
        """
        written = lists

        def narrowed(turn: int) -> DataFrame:
            # a closed list never opens again; what it was made from is read no more
            nonlocal written
            out = self.open_lists(lists.select("token", "g", "n", "w"), turn)
            discard(written)
            written = out
            return out

        for turn in range(seed, seed + turns):
            lists = narrowed(turn)
            stars = lists.where("c <> hub_c").groupBy(F.col("hub").alias("a"), F.col("g").alias("b")).agg(F.count("*").alias("k"), F.first("n").alias("n"))
            worth = materialize(stars.where(f"{part} * k >= n").select("a", "b"), "stars")
            tried = worth.count()
            found = self.add(worth) if tried else 0
            if 20 * found < tried or not tried:
                return narrowed(0) if found else lists
        return narrowed(0)


def list_pairs(lists: DataFrame) -> DataFrame:
    """(a, b, k) of the pairs of different classes in lists that sizes allow, k: lists that hold both.

    most: how many of a node's shingles other classes hold at all, so two nodes share no more than the lesser of both.
    """
    cols = lambda s: ["token", *[F.col(c).alias(f"{c}{s}") for c in ("g", "c", "n", "most")]]
    left, right = lists.select(*cols("a")), lists.select(*cols("b"))
    fits = f"ga < gb and ca <> cb and 100 * least(na, nb) >= {PERCENT} * greatest(na, nb) and {100 + PERCENT} * least(mosta, mostb, na, nb) >= {PERCENT} * (na + nb)"
    met = left.join(right, "token").where(fits)
    return met.groupBy(F.col("ga").alias("a"), F.col("gb").alias("b")).agg(F.count("*").alias("k"), F.first("na").alias("na"), F.first("nb").alias("nb"))


def explode_sets(sets: DataFrame) -> DataFrame:
    """(token, g) over whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, toks in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
                t = _unpack(toks.as_py()).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.full(len(t), g, np.int64))], names=["token", "g"])

    return bound_batches(sets).select("g", "toks").mapInArrow(run, "token long, g long")


def _rare_pairs(open_: DataFrame, least) -> tuple[DataFrame, DataFrame]:
    """Pairs of different classes that meet in a rare list and may share enough in all, and each node's number of frequent tokens.

    Tokens of closed lists are held by one class only, so open lists hold all that two classes share.
    """
    many = materialize(open_.where(F.col("df") > RARE).groupBy("g").agg(F.count("*").alias("h"), F.first("n").alias("n")), "many")
    h = lambda side: many.select(F.col("g").alias(side), F.col("h").alias(f"h{side}"))
    rated = list_pairs(open_.where(F.col("df") <= RARE).withColumn("most", F.col("n"))).join(h("a"), "a", "left").join(h("b"), "b", "left")
    pairs = rated.where(F.col("k") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) >= least).select("a", "b")
    return materialize(pairs, "pairs"), many


def combinations(open_: DataFrame) -> DataFrame:
    """(token, g, n, c, most): the index of extended rare-first prefixes of whole sets; token is a key of one or two tokens.

    Tokens that no other class holds come first, then the others by exact frequency. The first missing + 1 + B of a node
    share at least B + 1 with those of a linked one. If one of these is rare, the two meet in its list. If all are frequent,
    two of them are in the same of B buckets of a hash, so both nodes hold that bucket's combination of the two: only
    combinations within a bucket are indexed, which keeps them below the size of the set. B follows the size class (power
    of two) of a pair's smaller node; a node whose partner may be one class below is indexed for that class as well.
    """
    own = Window.partitionBy("g")
    frequent = F.col("df") > RARE
    ranked = open_.withColumn("r", F.row_number().over(own.orderBy("df", "token"))).withColumn("all", F.count("*").over(own)).withColumn("h", F.count(F.when(frequent, 1)).over(own))
    ranked = ranked.withColumn("k", F.floor(F.log2("n")).cast("int"))
    buckets = lambda k: f"greatest(1, shiftleft(1, {k}) div 8)"
    # the place in the open part of the order up to which a prefix extended for class k reaches
    last = lambda k: f"n - (n * {PERCENT} + 99) div 100 + 1 + {buckets(k)} - (n - all)"
    near = materialize(ranked.where(F.expr(f"r <= {last('k')}")), "near")
    rare = near.where(~frequent).select(F.xxhash64("token").alias("token"), "g", "n", "c", F.col("all").alias("most"))
    classes = F.expr(f"case when k > 0 and {PERCENT} * n < 100 * shiftleft(1, k) then array(k, k - 1) else array(k) end")
    dealt = near.where(frequent).withColumn("kk", F.explode(classes)).where(F.expr(f"r <= {last('kk')}"))
    held = dealt.groupBy("g", "n", "c", "h", "kk", F.expr(f"pmod(xxhash64(token), {buckets('kk')})").alias("bucket")).agg(F.array_sort(F.collect_list("token")).alias("t"))
    two = F.expr("explode(flatten(transform(t, (x, i) -> transform(slice(t, i + 2, size(t)), y -> xxhash64(kk, x, y)))))")
    # a pair that meets in no rare list shares frequent shingles only, and no more than either has
    return rare.unionByName(held.where(F.size("t") > 1).select(two.alias("token"), "g", "n", "c", F.col("h").alias("most")))


def link_classes(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(g, c) of the nodes that link with another.

    texts: (key, text) of every document; nodes: (g, n, key, single), one key for each different set, and whether only one
    row of texts has that key.
    """
    spark = texts.sparkSession
    lists = materialize(shared_lists(prefix_postings(texts)), "lists")
    # a node that shares fewer indexed shingles than linked nodes must has no link
    held = lists.groupBy("g").agg(F.count("*").alias("k")).join(nodes, "g").where("k >= 1 + (8 * n) div 100")
    able = materialize(held.select("g", "n", "key", "single", (F.col("k") / F.col("n")).alias("w")), "able")
    count = able.count()
    if not count:
        return spark.createDataFrame([], "g long, c long")
    keyed = able.select("g", "n", "key", "single")
    found = set_table(only(texts, "key", keyed.where("single"), count))
    repeated = keyed.where("not single")
    if repeated.limit(1).count():
        found = found.unionByName(set_table(only(texts, "key", repeated, count)).groupBy("g", "n").agg(F.first("toks").alias("toks")))
    sets = materialize(found, "sets")
    classes = Classes(spark, sets)
    chosen = materialize(only(lists, "g", able.select("g", "n", "w"), count), "able-lists")
    discard(lists)
    open_ = classes.contract(chosen, 10, STARS, 0)
    pairs, many = _rare_pairs(open_, 1 + F.floor(F.least("na", "nb") / 10))
    if pairs.count():
        classes.add(pairs)
    # a pair left over shares frequent shingles only: both nodes have enough of them
    again = materialize(many.where("h >= 1 + (8 * n) div 100").select("g", "n"), "again")
    discard(open_)
    if again.limit(1).count():
        count = again.count()
        whole = materialize(shared_lists(explode_sets(only(sets, "g", again.select("g"), count))), "whole")
        share = materialize(whole.groupBy("g").agg(F.count("*").alias("k")).join(again, "g").select("g", "n", (F.col("k") / F.col("n")).alias("w")), "share")
        open_ = classes.contract(only(whole, "g", share, count), 5, 3 * STARS, 10)
        discard(whole)
        index = materialize(combinations(open_), "index")
        pairs = materialize(list_pairs(index).select("a", "b"), "pairs")
        if pairs.count():
            classes.add(pairs)
        discard(open_)
        discard(index)
    discard(sets)
    return classes.label


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    key = F.xxhash64("doc_id", "text")
    own = materialize(document_sets(docs.select("doc_id", "text", key.alias("key")), ["doc_id", "key"]), "sets-of")
    rows = own.where("g is not null").groupBy("g", "n", "key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    pick = F.min(F.struct((F.col("rows") > 1).alias("many"), "key")).alias("at")
    nodes = materialize(rows.groupBy("g", "n").agg(F.min("doc_id").alias("doc_id"), pick).select("g", "n", "doc_id", F.col("at.key").alias("key"), (~F.col("at.many")).alias("single")), "nodes")
    label = link_classes(docs.select(key.alias("key"), "text"), nodes)
    named = nodes.join(label, "g", "left").withColumn("c", F.coalesce("c", "g"))
    low = materialize(named.join(named.groupBy("c").agg(F.min("doc_id").alias("component_id")), "c").select("g", "n", "component_id"), "named")
    return own.join(low, ["g", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that are first of their class: docs' own columns, one document of each group of linked ones.

    Texts without words have no class and stay; of rows with the same id and set one stays. Rows are written once with a
    number; only their texts go to Python, and a row stays if its number is the first of its class.
    """
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    rows = materialize(document_sets(numbered, ["row", "doc_id", "_row"]), "rows")
    nodes = materialize(rows.where("g is not null").groupBy("g", "n").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("at")), "nodes")
    label = link_classes(rows.select(F.col("_row").alias("key"), "row.text"), nodes.select("g", "n", F.col("at._row").alias("key"), F.lit(True).alias("single")))
    named = nodes.join(label, "g", "left").withColumn("c", F.coalesce("c", "g"))
    first = named.groupBy("c").agg(F.min("at").alias("at")).select(F.col("at._row").alias("_row"))
    stay = materialize(first.unionByName(rows.where("g is null").select("_row")), "stay")
    return only(rows, "_row", stay, stay.count()).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\x0C\r]+') AS words FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(words[i : i + 4], ' ') AS shingle FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
met AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.rid < b.rid GROUP BY 1, 2),
link AS (SELECT a, b FROM met JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT rid, rid AS other FROM w UNION SELECT r.rid, e.b FROM reach r JOIN edge e ON e.a = r.other),
low AS (SELECT reach.rid, min(w.doc_id) AS component_id FROM reach JOIN w ON w.rid = other GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM w LEFT JOIN n USING (rid) JOIN low USING (rid)
"""
