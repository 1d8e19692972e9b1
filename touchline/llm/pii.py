"""Personal data by base patterns and bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the base entities (e-mail, IP, card, phone) and secrets that their shape gives away (long hexadecimal or mixed
tokens). The one to three words before and the one or two after an entity are its lexical patterns. Patterns and instances
form a bipartite graph; also in it are the other tokens and digit groups that could be identifiers. Scores go back and
forth for ROUNDS rounds: a pattern is worth the share of worthy instances among all places of its words in the corpus (plus
one), an instance the chance that its best pattern on the left or on the right is right. A token is discovered (kind
`id`) if one of its patterns has MIN_SUPPORT different instances and both scores reach ACCEPT. Base spans always stay; a shape alone adds no span.

Spans come from splitting a text at a pattern: the pieces' and matches' lengths add up to code-point offsets, their
white space to word numbers. The regexes are the base patterns made linear by possessive loops and by not starting inside a run
that was already refused; lists grow in blocks, so that a text with very many matches is not copied at each of them.
Patterns, instances and n-grams are 64-bit hashes.

Defined cases: a null text counts as empty; a text without entities has the hash of the empty string; repeated rows are
searched each, count once as instance and each as place; an empty table gives an empty result; null ids are kept; words and texts of any length
count whole; extra columns pass through redact, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.base import discard, materialize, table

KINDS = ("email", "ip", "card", "phone", "id")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": r"(?<![0-9A-Za-z_-])(?:\(?[0-9]{2,}+\)?+(?:[\x20.-]\(?[0-9]{2,}+\)?+)++(?![0-9A-Za-z_-])|(?=[A-Za-z_-]*+[0-9])[0-9A-Za-z]++(?:[_-][0-9A-Za-z]++)*+)",
}
#: Texts without this are not searched for the kind.
NEEDS = {"email": "@", "ip": r"\.", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+", "id": "[0-9]"}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.(?!$)|$)){4}$"
#: Shapes of secrets that serve as seeds.
SECRET = r"^(?:(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{32,}|(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z_-]{24,})$"
ROUNDS, ACCEPT, MIN_SUPPORT = 3, 0.8, 5
#: Elements that a list grows by before it is set aside; n-grams up to which their set is broadcast (8 bytes each).
BLOCK, BROADCAST_ROWS = 256, 100_000
SPACE = r"[\x20\x09-\x0D]+"
#: before, after: hashes of the patterns on either side; a null one has too few words.
SPAN = "struct<start:int,k:int,end:int,m:string,w:int,v:int,lead:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(IP_PARTS)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "id":
        return (F.length(digits) >= 3) & (F.length(F.regexp_replace(m, "[^0-9A-Za-z]", "")) >= 6)
    return F.lit(True)


def grown(cur: Column, done: Column, item: Column, kind: str) -> tuple[Column, Column]:
    """(cur, done) after an item: cur holds up to BLOCK of them, done the full blocks."""
    full = F.size(cur) >= BLOCK
    return (
        F.when(full, F.array(item)).otherwise(F.concat(cur, F.array(item))).cast(f"array<{kind}>").alias("cur"),
        F.when(full, F.concat(done, F.array(cur))).otherwise(done).cast(f"array<array<{kind}>>").alias("done"),
    )


def spans(text: Column, kind: str) -> Column:
    """array<SPAN> of a kind's valid matches; w and v: the numbers of its first and last word, lead: that word's part before it."""
    pattern = PATTERNS[kind]
    piece = lambda p, m: F.struct(
        F.length(p).alias("gap"), F.regexp_count(p, F.lit(SPACE)).alias("words"), F.element_at(F.split(p, SPACE), -1).alias("lead"), m.alias("m")
    )
    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), piece)
    start = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("w"), F.array().cast(f"array<{SPAN}>").alias("cur"), F.array().cast(f"array<array<{SPAN}>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        at, w = acc["pos"] + x["gap"], acc["w"] + x["words"]
        inner = F.coalesce(F.regexp_count(x["m"], F.lit(SPACE)), F.lit(0))
        end = at + F.coalesce(F.length(x["m"]), F.lit(0))
        item = F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("k"), end.alias("end"), x["m"].alias("m"), w.alias("w"), (w + inner).alias("v"), x["lead"].alias("lead"))
        cur, done = grown(acc["cur"], acc["done"], item, SPAN)
        good = x["m"].isNotNull() & _valid(kind, x["m"])
        return F.struct(end.alias("pos"), (w + inner).alias("w"), F.when(good, cur).otherwise(acc["cur"]).alias("cur"), F.when(good, done).otherwise(acc["done"]).alias("done"))

    found = F.aggregate(parts, start, step, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["cur"]))))
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _patterns(words: Column, s: Column) -> Column:
    """The n-grams of a span's left and right words: struct<side, gram>, one to three and one to two words."""
    lead = F.regexp_replace(F.lower(s["lead"]), r"^[\"'(<\[{]+|[\"'(<\[{]+$", "")
    own = lead != ""
    word = lambda i: F.nullif(F.get(words, i), F.lit(""))
    a, b, c = F.when(own, lead).otherwise(word(s["w"] - 1)), word(s["w"] - F.when(own, 1).otherwise(2)), word(s["w"] - F.when(own, 2).otherwise(3))
    d, e = word(s["v"] + 1), word(s["v"] + 2)
    gram = lambda side, *of: F.when(sum((x.isNull().cast("int") for x in of), F.lit(0)) == 0, F.struct(F.lit(side).alias("side"), F.xxhash64(*of).alias("gram")))
    return F.filter(F.array(gram(0, a), gram(0, b, a), gram(0, c, b, a), gram(1, d), gram(1, d, e)), lambda x: x.isNotNull())


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep columns, base spans by start and kind, and open candidates that no base span touches (each with its patterns), of each row."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = F.array_sort(F.concat(*[spans(t, k) for k in KINDS[:4]]))
    # candidates are searched in what base spans leave
    rest = lambda b: F.when(F.size(b) > 0, replaced(t, b, hidden, hidden)).otherwise(t)
    both = let(base, lambda b: F.struct(b.alias("base"), let(rest(b), lambda x: spans(x, "id")).alias("open")))
    each = docs.select(*[F.col(f"`{k}`").alias(f"c{i}") for i, k in enumerate(keep)], t.alias("t"), both.alias("both"))
    lean = lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"))
    known = lambda w, s: F.struct(
        s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"), F.xxhash64(F.lower(s["m"])).alias("instance"), F.when(s["k"] < 4, 2).when(s["m"].rlike(SECRET), 1).otherwise(0).alias("seed"), _patterns(w, s).alias("patterns")
    )
    some = F.size("both.base") + F.size("both.open") > 0
    graph = F.when(some, let(F.split(F.lower("t"), SPACE), lambda w: F.transform(F.concat("both.base", "both.open"), lambda s: known(w, s))))
    return each.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(keep)], F.transform("both.base", lean).alias("base"), graph.alias("graph"))


def edges(found: DataFrame) -> DataFrame:
    """The pattern-instance graph: (side, gram, instance) with seed (2: base entity, 1: secret by shape, 0) and places."""
    long = found.select(F.explode("graph").alias("s")).select("s.instance", "s.seed", F.explode("s.patterns").alias("p"))
    return long.groupBy("p.side", "p.gram", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("places"))


def occurrences(docs: DataFrame, grams: DataFrame, text: str = "text") -> DataFrame:
    """(gram, total): how often each n-gram of grams stands in the whole texts of docs."""
    count = grams.count()
    words = F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), SPACE)
    at = lambda w, i: F.array(F.xxhash64(F.get(w, i)), F.xxhash64(F.get(w, i), F.get(w, i + 1)), F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    each = docs.select(F.explode(let(words, lambda w: F.flatten(F.transform(w, lambda x, i: at(w, i))))).alias("gram"))
    return each.join(F.broadcast(grams) if count <= BROADCAST_ROWS else grams, "gram").groupBy("gram").agg(F.count("*").alias("total"))


def bootstrap(graph: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(side, gram, instance) whose instance is discovered there; graph is written, docs are the texts that it came from."""
    by = graph.groupBy("side", "gram").agg(F.count("*").alias("support"), F.max("seed").alias("most"), F.min("seed").alias("least"))
    # only patterns with seeds and with something to discover can discover it
    able = materialize(by.where((F.col("support") >= MIN_SUPPORT) & (F.col("most") > 0) & (F.col("least") < 2)).select("side", "gram", "support"), "able")
    if able.limit(1).count() == 0:
        return able.select("side", "gram", F.col("support").alias("instance")).limit(0)
    total = occurrences(docs, able.select("gram").distinct(), text)
    rated = able.join(total, "gram", "left").select("side", "gram", "support", F.coalesce("total", F.lit(0)).alias("total"))
    live = materialize(graph.join(rated, ["side", "gram"]).withColumn("worth", F.least("seed", F.lit(1)).cast("double")), "graph")
    for _ in range(ROUNDS):
        trust = (F.sum(F.col("places") * F.col("worth")) / (F.greatest(F.first("total"), F.sum("places")) + 1)).alias("trust")
        rated = live.drop("worth", "trust").join(live.groupBy("side", "gram").agg(trust), ["side", "gram"])
        best = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("trust"))), F.lit(0.0))
        chance = rated.groupBy("instance").agg((1 - (1 - best(0)) * (1 - best(1))).alias("chance"))
        last, live = live, materialize(rated.join(chance, "instance").withColumn("worth", F.when(F.col("seed") > 0, 1.0).otherwise(F.col("chance"))).drop("chance"), "graph")
        discard(last)
    return live.where((F.col("seed") < 2) & (F.col("trust") >= ACCEPT) & (F.col("worth") >= ACCEPT)).select("side", "gram", "instance")


def discover(found: DataFrame, key: str, docs: DataFrame) -> DataFrame:
    """(key, extra): the discovered spans of the rows that have any; found is written, so its keys hold still."""
    graph = materialize(edges(found), "edges")
    right = materialize(bootstrap(graph, docs), "right")
    discard(graph)
    place = lambda c: F.col(f"s.{c}").alias(c)
    hits = found.where(F.exists("graph", lambda s: s["seed"] < 2)).select(key, F.explode("graph").alias("s")).where("s.seed < 2").select(key, place("start"), place("k"), place("end"), place("instance"), F.explode("s.patterns").alias("p"))
    hits = hits.select(key, "start", "k", "end", "instance", "p.side", "p.gram").join(right, ["side", "gram", "instance"], "left_semi")
    return hits.groupBy(key).agg(F.collect_set(F.struct("start", "k", "end")).alias("extra"))


def with_spans(found: DataFrame, docs: DataFrame) -> DataFrame:
    """found with spans: base and discovered ones, by start and kind."""
    extra = materialize(discover(found, "_row", docs), "extra").withColumnRenamed("_row", "_r")
    joined = found.join(extra, F.col("_row") == F.col("_r"), "left").drop("_r")
    return joined.withColumn("spans", F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra")))).drop("extra", "graph")


def name_of(s: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["k"] + 1)


def hidden(part: Column, s: Column) -> Column:
    """The stretch from the previous cut to the next, its base spans in underscores: they start no candidate."""
    return F.regexp_replace(part, r"[^\x20\x09-\x0D]", "_")


def replaced(text: Column, spans_: Column, before: Callable[[Column, Column], Column] | None, last: Callable | None, after: Callable[[Column], Column] | None = None) -> Column:
    """The text with every span (and what overlaps it) rewritten: before makes it from its text, or after names it by the span."""
    cut = "struct<from:int,pos:int,start:int,k:int>"
    start = F.struct(F.lit(0).alias("from"), F.lit(0).alias("pos"), F.array().cast(f"array<{cut}>").alias("cur"), F.array().cast(f"array<array<{cut}>>").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        cur, done = grown(acc["cur"], acc["done"], F.struct(acc["from"].alias("from"), acc["pos"].alias("pos"), s["start"].alias("start"), s["k"].alias("k")), cut)
        apart = s["start"] >= acc["pos"]
        return F.struct(F.when(apart, s["start"]).otherwise(acc["from"]).alias("from"), F.greatest(acc["pos"], s["end"]).alias("pos"), F.when(apart, cur).otherwise(acc["cur"]).alias("cur"), F.when(apart, done).otherwise(acc["done"]).alias("done"))

    def block(group: Column) -> Column:
        # one stretch of the text a block, so that places are counted from its start
        lo = F.element_at(group, 1)["from"]

        def one(part: Column, s: Column) -> Column:
            gap = F.substring(part, s["pos"] - lo + 1, s["start"] - s["pos"])
            return F.concat(before(F.substring(part, s["from"] - lo + 1, s["pos"] - s["from"]), s), gap) if before else F.concat(gap, after(s))

        return let(F.substring(text, lo + 1, F.element_at(group, -1)["start"] - lo), lambda part: F.array_join(F.transform(group, lambda s: one(part, s)), ""))

    def finish(acc: Column) -> Column:
        parts = [F.array_join(F.transform(F.filter(F.concat(acc["done"], F.array(acc["cur"])), lambda g: F.size(g) > 0), block), "")]
        if last:
            parts.append(last(F.substring(text, acc["from"] + 1, acc["pos"] - acc["from"]), acc))
        return F.concat(*parts, F.substring(text, acc["pos"] + 1, F.length(text)))

    return F.aggregate(spans_, start, step, finish)


def covered(text: Column, spans_: Column) -> Column:
    """The text with every span replaced by its kind in brackets; an overlapping span goes with the one before it."""
    return replaced(text, spans_, None, None, lambda s: F.concat(F.lit("["), F.upper(name_of(s)), F.lit("]")))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of its texts replaced by its kind in brackets (and n_chars, if there, counted anew); null texts stay null."""
    own = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), "text")
    found = materialize(find(inner, ["row"]).withColumn("_row", F.monotonically_increasing_id()), "spans")
    text = F.when(F.size("spans") > 0, covered(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    kind = docs.schema["n_chars"].dataType if "n_chars" in own else None
    column = lambda c: F.col("_new").alias("text") if c == "text" else F.when(F.size("spans") > 0, F.length("_new").cast(kind)).otherwise(F.col("row")[c]).alias(c) if c == "n_chars" else F.col("row")[c].alias(c)
    return with_spans(found, docs).withColumn("_new", text).select(*[column(c) for c in own])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(find(docs, ["doc_id"]).withColumn("_row", F.monotonically_increasing_id()), "spans")
    joined = lambda spans_: F.concat_ws(",", F.transform(spans_, lambda s: F.concat_ws(":", name_of(s), s["start"].cast("string"), s["end"].cast("string"))))
    count = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return with_spans(found, docs).select("doc_id", *[count(k) for k in range(4)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count(4), F.size("spans").cast("long").alias("n_spans"))
