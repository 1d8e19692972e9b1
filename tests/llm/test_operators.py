"""Operators against brute force, oracles, exact round trips and held-out accuracy, over one small fixture with odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import html_extract, language, mixing, ngram_join, pii, quality_model, quality_rules, sentencepiece_scan, topk, toxicity
from touchline.llm.kernels import repeated_words, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture_rows():
    rng = random.Random(3)
    syll = {"en": "the er on an re he in ed nd ha at es".split(), "fr": "le la de ou eau tion ê ai ch ré".split()}
    prose = lambda lang, n: " ".join("".join(rng.choice(syll[lang]) for _ in range(rng.randint(1, 3))) + rng.choice(["", "", "", ".", ","]) for _ in range(n))
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        text = prose(lang, rng.randint(25, 160))
        if i % 10 == 4:
            text += " write x.y@mail.example.com or 10.0.0.1 or +1 (555) 555-1234 or 4111 1111 1111 1111"
        if i % 7 == 3:
            text += " you are a stupid moron. such an idiot clown"
        rows.append((i, text, lang, f"s{i % 4}"))
    near = rows[7][1].split()
    for k in range(4):
        rows.append((100 + k, " ".join([*near[: len(near) - 1 - k], "x"]), "en", "s0"))
    boiler = prose("en", 60)
    rows += [(200 + k, boiler + " " + prose("en", 8), "en", "s1") for k in range(25)]
    rows += [(300, None, "en", "s1"), (301, "", None, None), (302, " \n\t ", "en", None), (303, "one two three", "en", "s2"), (304, "ONE two three", "en", "s2"), (7, rows[7][1], "en", "s3"), (7, rows[7][1], "en", "s3")]
    rows += [(305, "12345 67890 !!", "xx", "s2"), (306, "ab " * 5000, "en", "hot"), (307, "aé" * 3000, "fr", "hot"), (308, rows[5][1], "en", "hot"), (None, "no id but some words in this row", "en", "s0")]
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows]


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(r[0], int(r[0] % 5 != 2), int("moron" in (r[1] or ""))) for r in ROWS if r[0] is not None and r[0] < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    rng = np.random.default_rng(0)
    vec = [(i, rng.normal(size=8).astype("float32").tolist(), 0) for i in range(450)] + [(500, None, 0), (600, [1.0, None] + [0.0] * 6, 0), (700, [float("nan")] * 8, 0), (800, [float("inf")] * 8, 0), (900, [0.5, 0.5], 0), (901, [0.25, 0.5], 0), (100, rng.normal(size=8).astype("float32").tolist(), 1)]
    vec += [(i, [0.0] * 8, 0) for i in range(1000, 1015)]
    spark.createDataFrame(vec, "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    pages = [(0, "u", PAGE), (1, "u", None), (2, None, ""), (3, "u", "plain &amp; text"), (4, "u", "<div" * 2000 + ">" + "<p>x"), (0, "u", PAGE)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return str(d)


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/a'>Menu</a></li></ul></nav><div class='ad'>Buy this, now.</div><article><h1>Head</h1><p><b>First, text &eacute;.<br>more<p>Second   one, it is.</p></article><div class='comments'><p>Nice, I liked it, really.</p></div><footer>&copy; x</footer></body></html>"


def oracle(sf, sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet/*.parquet')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()), key=str)


def spark_rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(u == v or isinstance(u, float) and abs(u - v) < 1e-6 for u, v in zip(x, y, strict=True)), (x, y)


def test_words_and_repeats():
    texts = ["a b  c\n", None, "", " \t", "x" * 10, "a b c d e f g h a b c d e f g h i"]
    got = dict(words(pa.array(texts)))
    assert [len(got[i]) for i in range(6)] == [3, 0, 0, 0, 1, 17]
    assert repeated_words(got[5], 8) == 16
    big = "w%d " * 1
    long = " ".join(big % i for i in range(400_000))
    assert len(next(words(pa.array([long])))[1]) == 400_000


def test_op1_against_sql(spark, sf):
    near(spark_rows(topk.query(spark, sf)), oracle(sf, topk.SQL, "embeddings"))


def test_op1_large_integers(spark):
    big = spark.createDataFrame([(i, [10.0**9 + i, 1.0]) for i in range(5)], "vec_id long, embedding array<double>")
    q, v = np.array([[1 << 30, 1]]), np.array([[(1 << 30) + i, 1] for i in range(5)])
    assert [x[1] for x in sorted(topk.dual_tree(np.array([0]), q, np.arange(5), v, 2), key=lambda t: -t[2])] == [4, 3]
    assert topk.vectors(big).count() == 5


def test_op2_held_out(spark, sf):
    r = language.query(spark, sf).join(spark.createDataFrame(ROWS, SCHEMA).select("doc_id", "lang", "text").distinct(), "doc_id").collect()
    assert all(x.lang_pred == "und" and x.score == 0 for x in r if not x.text or not any(c.isalpha() for c in x.text))
    held = [x for x in r if x.held_out and x.text and x.lang in ("en", "fr") and len(x.text) > 50]
    assert np.mean([x.lang == x.lang_pred for x in held]) > 0.9 and all(0 <= x.score <= 1 for x in r)


@pytest.mark.parametrize("op", [quality_model, toxicity])
def test_op3_op5_scores(spark, sf, op):
    r = op.query(spark, sf).collect()
    assert len(r) == len(ROWS) and all(0 <= x.score <= 1 for x in r)
    if op is toxicity:
        by = {x.doc_id: x for x in r}
        assert all((by[d].predicted == 1) == ("moron" in (t or "")) for d, t, *_ in ROWS if d is not None and d < 60)
        g = toxicity.Grammar([], [])
        assert g.score("you are an idiot")[0] > g.score("an idiot")[0] > g.score("not an idiot")[0] > 0 == g.score("the killer whale")[0]
        assert g.score("he said an idiot came")[0] < g.score("an idiot came")[0] and g.score("I will kill you")[0] > 0 == g.score("kill")[0]


def brute_pii(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum((int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2)) for i, c in enumerate(reversed(d))) % 10 == 0

    base = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(base) for m in re.finditer(p, text) if ok(m.group()))
    return [sum(s[1] == k for s in spans) for k in range(4)], hashlib.sha256(",".join(f"{base[k][0]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_op4_against_brute_force(spark, sf, tmp_path):
    rng = random.Random(5)
    odd = [(i, "".join(rng.choice("ab@.%+-_ 0123456789()é\n1234.,") for _ in range(rng.randint(0, 150)))) for i in range(300)] + [(900, "x@y.zz@q.rr%x@d.e-f.g 1.2.3.4.5.6.7.8 00255.0.0.256"), (901, "1 " * 20000), (902, "a" * 100000), (903, None)]
    spark.createDataFrame(odd, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for d, rows in ((str(tmp_path), odd), (sf, [r[:2] for r in ROWS])):
        want = sorted(str(brute_pii(t)) for _, t in rows if len(t or "") < 30000) if d == sf else None
        got = pii.query(spark, d).collect()
        assert len(got) == len(rows)
        if d == sf:
            assert sorted(str(([x.n_email, x.n_ip, x.n_card, x.n_phone], x.base_sha256)) for x in got) == want
        else:
            by = dict(rows)
            assert all(([x.n_email, x.n_ip, x.n_card, x.n_phone], x.base_sha256) == brute_pii(by[x.doc_id]) for x in got if x.doc_id < 901 or x.doc_id == 903)


def test_op4_spaced_cards(spark, tmp_path):
    """Cards in texts without two adjacent digits."""
    rows = [(i, f"pay by {sep.join('4111111111111111')} today") for i, sep in enumerate((" ", "-"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: ([x.n_email, x.n_ip, x.n_card, x.n_phone], x.base_sha256) for x in pii.query(spark, str(tmp_path)).collect()}
    assert got == {d: brute_pii(t) for d, t in rows} and all(x[0] == [0, 0, 1, 0] for x in got.values())
    assert [r.text for r in pii.redact(docs).collect()] == ["pay by [CARD] today"] * 2


def test_op4_discovers_by_context(spark):
    seeds = [(i, f"please call agent number {4111111111111111 if i == 0 else ''} my badge code +1 555 555 {1000 + i} thanks") for i in range(12)]
    docs = spark.createDataFrame([*seeds, (99, "here my badge code 77-12345-AB is new")], "doc_id long, text string")
    assert "[ID]" in [r.text for r in pii.redact(docs).where("doc_id = 99").collect()][0]


def test_op6_against_brute_force():
    pieces = sentencepiece_scan.read_model(sentencepiece_scan.default_model())
    enc = sentencepiece_scan.Encoder(pieces)
    index = {p: i for i, (p, _, k) in enumerate(pieces) if k == 0}

    def brute(text):
        cp = enc.symbols(text) if text else []
        chars, n = [chr(c) if c < 0x110000 else None for c in cp], len(cp)
        best, back = [0.0] + [-1e300] * n, [None] * (n + 1)
        for i in range(n):
            for size in range(1, min(16, n - i) + 1):
                s = None if None in chars[i : i + size] else "".join(chars[i : i + size])
                pid = index.get(s, -1) if s else -1
                if pid < 0 and size > 1:
                    continue
                v = best[i] + (enc.score[pid] if pid >= 0 else enc.unk)
                if v > best[i + size]:
                    best[i + size], back[i + size] = v, (i, pid)
        out, p = [], n
        while p:
            i, pid = back[p]
            out, p = ([*enc._bytes(int(cp[i]))] if pid < 0 else [pid]) + out, i
        return [int(x) for x in out]

    rng = random.Random(1)
    texts = [None, "", " ", "a  b\n\tc ﬁ é ", "▁x ▁", "🙂 hi 🙂", "\x00\x07", "a" * 500, " " * 300] + ["".join(rng.choice("abcdetionsrhl ") for _ in range(rng.randint(1, 300))) for _ in range(20)] + ["".join(rng.choice("abcdetionsrhl") for _ in range(rng.randint(49, 400))) for _ in range(20)]
    got = enc.encode(texts)
    assert [list(map(int, g)) for g in got] == [brute(t) for t in texts]
    assert [enc.decode(g.tolist()) for g in got] == [t or "" for t in texts]


def test_op6_is_no_worse_than_a_unigram_processor():
    """No path of the library's own Viterbi over the same pieces, with the model's type set to unigram, scores more."""
    import sentencepiece

    def fields(b):
        at = 0
        while at < len(b):
            start, key, shift = at, 0, 0
            while True:
                key |= (b[at] & 127) << shift
                shift += 7
                at += 1
                if b[at - 1] < 128:
                    break
            size, shift = 0, 0
            if key & 7 == 5:
                body = at
                at += 4
            else:
                while True:
                    size |= (b[at] & 127) << shift
                    shift += 7
                    at += 1
                    if b[at - 1] < 128:
                        break
                body = at
                at += size if key & 7 == 2 else 0
            yield key >> 3, start, body, at

    model = sentencepiece_scan.default_model()
    number, start, body, end = next(f for f in fields(model) if f[0] == 2)
    trainer = model[body:end]
    _, s, b, e = next(f for f in fields(trainer) if f[0] == 3)
    changed = model[:body] + trainer[: e - 1] + b"\x01" + trainer[e:] + model[end:]
    sp = sentencepiece.SentencePieceProcessor(model_proto=changed)
    enc = sentencepiece_scan.Encoder(sentencepiece_scan.read_model(model))
    for text in ["the quick brown fox jumps", "Thndor, ernd reer thor edtionnt", "leçon de français"]:
        assert enc.score[enc.encode([text])[0]].sum() >= sum(sp.get_score(i) for i in sp.encode(text)) - 1e-3


def test_op7_against_sql(spark, sf):
    near(spark_rows(mixing.query(spark, sf)), oracle(sf, mixing.SQL, "documents"))


def test_op8(spark, sf):
    got = {r.page_id: r for r in html_extract.query(spark, sf).collect()}
    assert got[0].text == "Head First, text é. more Second one, it is." and got[0].n_chars == len(got[0].text)
    assert (got[1].text, got[2].text, got[3].text) == ("", "", "plain & text")


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[root(i)].append(d)
    return [(d, len(sets[i]), min([x for x in low[root(i)] if x is not None], default=None)) for i, (d, _) in enumerate(rows)]


def test_op9_against_brute_force(spark, sf):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.query(spark, sf).collect()]
    assert sorted(got, key=str) == sorted(brute_components([r[:2] for r in ROWS]), key=str)


def test_op9_hot_passages(spark, tmp_path):
    """More sharers of one passage than a rare list holds: mostly passage, half passage, and a chain of near copies."""
    rng = random.Random(9)
    w = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, base = w(60), w(120)
    rows = [(i, " ".join(passage + w(rng.choice([3, 6, 9, 12, 60])))) for i in range(60)]
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = w(1)[0]
        rows.append((100 + i, " ".join(t)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.query(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(brute_components(rows))


def test_op9_null_ids(spark, tmp_path):
    """Near copies without ids, copies of one of them, and one without an id that bridges two documents."""
    w = lambda name: [f"{name}{i}" for i in range(100)]
    cut = lambda t, head, tail: " ".join(["x"] * head + t[head : 100 - tail] + ["y"] * tail)
    rows = [(None, cut(w("a"), 0, k)) for k in (0, 0, 3, 6)] + [(1, cut(w("b"), 0, 0)), (None, cut(w("b"), 0, 8)), (2, cut(w("b"), 8, 8)), (3, cut(w("c"), 0, 0))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(brute_components(rows), key=str)
    assert [r.doc_id for r in ngram_join.one_of_each(docs).orderBy("doc_id").collect()] == [None, 1, 3]


def test_components_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART", 20)
    edges = [(i, i + 1) for i in range(0, 199) if i % 50 != 49]
    random.Random(0).shuffle(edges)
    links = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r.g: r.c for r in ngram_join.components(links, len(edges)).collect()}
    assert got == {i: i // 50 * 50 for i in range(200)}


def test_op10_against_sql(spark, sf):
    near(spark_rows(quality_rules.query(spark, sf)), oracle(sf, quality_rules.SQL, "documents"))


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("embeddings", "vec_id long, embedding array<float>, label int"), ("pages", "page_id long, url string, html string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for op in (topk, language, quality_model, pii, toxicity, sentencepiece_scan, mixing, html_extract, ngram_join, quality_rules):
        assert op.query(spark, str(tmp_path)).count() == 0


def test_pipeline_against_brute_force(spark, sf):
    """Each stage on its own input; clashing extra columns pass through."""
    extra = spark.createDataFrame([(*r, 1, "x", 2.0) for r in ROWS], SCHEMA + ", n_words int, c string, target double")
    own = extra.columns
    judged = {(r.doc_id, r.n_words): r.kept for r in quality_rules.query(spark, sf).collect()}
    docs = corpus_pipeline.materialize(corpus_pipeline.rules_stage(spark, extra, sf), "t0")
    kept = [r for r in ROWS if judged[r[0], len(WORD.findall(r[1] or ""))]]
    assert docs.columns == own and sorted(str(r.doc_id) for r in docs.collect()) == sorted(str(r[0]) for r in kept)
    before = [(r.doc_id, r.text) for r in docs.collect()]
    docs = corpus_pipeline.materialize(corpus_pipeline.near_duplicates_stage(spark, docs, sf), "t1")
    want = {c for d, n, c in brute_components(before) if n}
    assert docs.columns == own and {r.doc_id for r in docs.collect()} == want and docs.count() == len(want)
    texts = {r.doc_id: r.text for r in docs.collect()}
    docs = corpus_pipeline.materialize(corpus_pipeline.pii_stage(spark, docs, sf), "t2")
    assert docs.columns == own and all(brute_pii(r.text)[0] == [0, 0, 0, 0] and (sum(brute_pii(texts[r.doc_id])[0]) or r.text == texts[r.doc_id]) and r.n_chars == len(r.text) for r in docs.collect())
    copies = defaultdict(int)
    mixed = corpus_pipeline.materialize(corpus_pipeline.mixing_stage(spark, docs, sf), "t3")
    for r in mixed.collect():
        copies[r.doc_id] += 1
    assert mixed.columns == own and max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in docs.collect()}
    enc = sentencepiece_scan.Encoder(sentencepiece_scan.read_model(sentencepiece_scan.default_model()))
    final = corpus_pipeline.tokens_stage(spark, mixed, sf).collect()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(final) == sum(copies.values()) and all(enc.decode(r.ids) == texts[r.doc_id] for r in final)


def test_mix_takes_what_the_query_says(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    taken = {r.source: r.n for r in mixing.query(spark, sf).join(docs.select("doc_id", "source").distinct(), "doc_id").groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    sizes = {r.source: r for r in mixing.plan(mixing.ordered_rows(docs)).collect()}
    assert all(abs(r.target) <= 3 * r.source_size + 1e-6 for r in sizes.values()) and taken
