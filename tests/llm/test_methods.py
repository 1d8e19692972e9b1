"""The methods' inner steps against plain second versions, and the pipeline as a whole on odd rows."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from test_operators import ROWS, SCHEMA, brute_components, brute_pii
from touchline.llm import features, html_extract, kernels, language, pii, quality_model, sentencepiece_scan, topk, toxicity


def test_op1_many_blocks(spark, monkeypatch):
    """Clusters, a third of the rows alike, several blocks a cell: the results of all pairs."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 300)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(6, 8)) * 3
    v = [(i, (centre[0] if i % 3 == 0 else centre[i % 6] + rng.normal(size=8) * 0.2).tolist()) for i in range(2400)]
    x = topk.vectors(spark.createDataFrame(v, "vec_id long, embedding array<double>"))
    got = sorted(tuple(r) for r in topk.search(x, x.where("vec_id % 100 = 0")).collect())
    m = np.floor(1024 * np.array([r[1] for r in v])).astype(np.int64)
    want = []
    for q in range(0, 2400, 100):
        s = m @ m[q]
        ids = [i for i in sorted(range(2400), key=lambda i: (-s[i], i)) if i != q][:10]
        want += [(q, k + 1, i, int(s[i])) for k, i in enumerate(ids)]
    assert got == sorted(want)


def test_op1_tree_invariants():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(400, 3)), np.zeros((300, 3))])
    todo, seen = [topk.cover_tree(points)], 0
    while todo:
        node = todo.pop()
        far = np.sqrt(((points[node.rows] - node.centre) ** 2).sum(1)).max()
        assert far <= node.radius + 1e-9 and any((points[r] == node.centre).all() for r in node.rows)
        if node.children:
            seen += 1
            assert sorted(r for c in node.children for r in c.rows) == sorted(node.rows)
            assert all(c.radius <= node.radius / topk.BASE + 1e-9 for c in node.children)
            assert all(np.sqrt(((a.centre - b.centre) ** 2).sum()) > node.radius / topk.BASE for a, b in itertools.combinations(node.children, 2))
            todo += node.children
    assert seen


def test_op1_beyond_64_bits(spark):
    rows = [(i, [1e18, 1e18 + i]) for i in range(3)] + [(100, [1e18, 1e18]), (200, [-1e18, 1.0])]
    x = topk.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r.vec_id, r.score) for r in topk.search(x, x.where("vec_id = 100")).orderBy("rank").collect()]
    assert got == [(0, topk.MOST), (1, topk.MOST), (2, topk.MOST), (200, -topk.MOST - 1)]


def test_op2_kernel_sum():
    """The folded product is the sum over landmarks of normalised presence kernels."""
    texts = ["the cat sat on the mat", "le chat est sur la table", "der Hund und die Katze", "the dog and the cat", "la maison et le chat", "die Katze ist da"] * 3
    langs = ["en", "fr", "de", "en", "fr", "de"] * 3
    rows = sorted((lang, np.packbits(language.spectrum(t, language.BITS)[0]).tobytes()) for t, lang in zip(texts, langs, strict=True))
    names, weights, bias = language.fit(rows)

    def grams(t):
        low = [ord(c.lower()) if c.isalpha() else 0 for c in t]
        return {int(features._slots(np.array(low[i : i + n], np.uint32), n, language.BITS)[0]) for n in (1, 2, 3) for i in range(len(low) - n + 1)}

    known = [set(np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8)))) for _, b in rows]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    x = np.array([[kernel(a, b) for b in known] for a in known])
    value, vector = np.linalg.eigh(x)
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    phi = x @ root
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for lang, _ in rows])
    c = phi - phi.mean(0)
    w = np.linalg.solve(c.T @ c + language.RIDGE * len(rows) * np.eye(phi.shape[1]), c.T @ (y - y.mean(0)))
    for t in ("the cat and the dog", "le chat", "Hund und Katze"):
        assert grams(t) == set(np.flatnonzero(language.spectrum(t, language.BITS)[0]))
        f = (np.array([kernel(grams(t), b) for b in known]) - 0) @ root @ w - phi.mean(0) @ w + y.mean(0)
        got, score = language.predict([t], (names, weights, bias))
        e = np.exp(language.SHARPNESS * (f - f.max()))
        assert got[0] == names[int(f.argmax())] and abs(score[0] - (e / e.sum()).max()) < 1e-3


def test_op2_every_language_and_long_texts(spark):
    """More languages than any cap, ids that repeat, and a text of several scans."""
    rng = random.Random(1)
    rows = [(None if i % 4 else 7, "".join(chr(0x4E00 + 40 * k + rng.randrange(40)) for _ in range(30)), f"l{k:03}") for k in range(300) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(language.sample(docs))
    assert len(model[0]) == 300
    long = "ab " * 400_000 + "xyz"
    assert (language.spectrum(long, 14)[0] == language.spectrum("ab ab ab xyz", 14)[0]).all()


def test_op3_dual_solution_is_the_least():
    rng = np.random.default_rng(2)
    x = np.hstack([rng.random((80, 6)) < 0.5, np.ones((80, 1))]).astype(float)
    sign = np.where(x[:, 0] + x[:, 1] * rng.random(80) > 0.9, 1.0, -1.0)
    w = quality_model.dual_descent(x, sign, 0.5, 500)
    loss = lambda w: w @ w / 2 + 0.5 * np.maximum(0, 1 - sign * (x @ w)).sum()
    assert all(loss(w) <= loss(w + step * d) + 1e-3 for d in rng.normal(size=(300, 7)) for step in (1e-3, 1e-2, 0.1))


def test_op3_indicators_count_by_hand(monkeypatch):
    text = "Aa b1 Aa b1 Aa b1, x\ny?"
    kind = lambda c: 2 if c.islower() else 3 if c.isupper() else 4 if c.isdigit() else 6 if c in "\n\r" else 5 if c.isspace() else 8 + ord(c)
    grams = Counter(tuple(kind(c) for c in text[i : i + 3]) for i in range(len(text) - 2))
    slots = Counter()
    for g, n in grams.items():
        slots[int(features._slots(np.array(g, np.uint32), 3, features.SHAPE_BITS)[0])] += n
    got = features.shape_indicators(text, next(kernels.words(pa.array([text])))[1])
    size = 1 << features.SHAPE_BITS
    for k, level in enumerate(features.LEVELS):
        assert {s for s, n in slots.items() if n / sum(slots.values()) > level} == set(np.flatnonzero(got[k * size : (k + 1) * size]))
    monkeypatch.setattr(features, "SCAN", 64)
    assert features.shape_indicators("ab " * 200, np.zeros(0, np.uint64)).any()


def test_op5_machine_is_the_product_of_four():
    """The composed machine against the four transducers run one by one; clauses of any length."""
    grammar = toxicity.Grammar([], [])
    words = ["idiot", "kill", "will", "you", "not", "said", '"', "cat"]
    rng = random.Random(3)
    for _ in range(300):
        tokens = [rng.choice(words) for _ in range(rng.randint(1, 30))]
        total, last = 0.0, {k: -99 for k in toxicity.MEMORY}
        report = 0
        for i, t in enumerate(tokens):
            kind = grammar.kind(t)
            active = {k: last[k] >= 0 and i - last[k] <= toxicity.MEMORY[k] for k in ("intent", "target", "negator")}
            if kind == "insult" or kind == "threat" and active["intent"]:
                weight = toxicity.THREAT if kind == "threat" else 1.0
                total += weight * (toxicity.NEAR if active["target"] else 1) * (toxicity.NEGATED if active["negator"] else 1) * (toxicity.REPORTED if report else 1)
            before = report
            report = max(0, report - 1)
            if kind == "reporter":
                report = toxicity.MEMORY["reporter"]
            elif kind == "quote":
                report = 0 if before > toxicity.MEMORY["reporter"] else toxicity.MEMORY["quote"]
            elif kind in last:
                last[kind] = i
        assert abs(grammar.run(tokens) - total) < 1e-9
    far = "said " + "cat " * 3 + "x" * 300 + " idiot"
    assert grammar.score(far)[0] == toxicity.REPORTED
    assert grammar.score("cat " * 50_000 + "idiot")[0] == 1.0


def brute_ratio(rows, container):
    """Path scores by their definition, with plain loops."""
    marks = lambda t: sum(c in ".,;:!?¡¿…。，、！？" for c in t)
    of = lambda keep: [r for r in rows if keep(r)]
    text = [sum(len(x[2]) for x in of(lambda x: x[0] == r[0])) / len(of(lambda x: x[0] == r[0])) for r in rows]
    mark = [sum(marks(x[2]) for x in of(lambda x: x[0] == r[0])) / len(of(lambda x: x[0] == r[0])) for r in rows]
    mean = lambda v, i: (v[max(i - 1, 0)] + 2 * v[i] + v[min(i + 1, len(v) - 1)]) / 4
    found = defaultdict(list)
    for i, r in enumerate(rows):
        same = of(lambda x: x[0] == r[0])
        own = mean(text, i) * (1 + mean(mark, i)) * (1 - sum(min(x[3], len(x[2])) for x in same) / sum(len(x[2]) for x in same))
        box = of(lambda x: container[x[1]] == container[r[1]])
        chars = sum(len(x[2]) for x in box)
        around = chars / len(box) * (1 + sum(marks(x[2]) for x in box) / len(box)) * (1 - sum(min(x[3], len(x[2])) for x in box) / chars)
        found[r[0]].append(max(own, 0) ** (1 / 3) * max(around, 0) ** (2 / 3))
    return {p: sum(v) / len(v) for p, v in found.items()}


def test_op8_path_scores_by_brute_force():
    rng = random.Random(6)
    for _ in range(40):
        nodes = 6
        container = [rng.randrange(nodes) for _ in range(nodes)]
        rows = [(p := rng.randrange(5), p, "".join(rng.choice("ab .,") for _ in range(rng.randint(1, 60))) + "x", rng.choice([0, 0, 5, 60])) for _ in range(rng.randint(1, 25))]
        got, want = html_extract.path_scores(rows, container), brute_ratio(rows, container)
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 * max(1, want[p]) for p in got)
        assert html_extract.content_paths(rows, container, 1e9) == (set() if any(got.values()) else set(got))


def test_op8_ratios_decide():
    prose = "The first of these long sentences, which has commas, goes on; and on, until it ends. Another follows it, of course."
    page = f"<body><div><a href=/>Home</a> <a href=/x>Shop</a></div><div><div><ul><li><a href=1>One</a><li><a href=2>Two</a></ul><p>Follow us</p></div><div><h1>Title</h1><p>{prose}</p><h2>Part</h2><p>{prose}</p><ul><li>short item<li>second item</ul><table><tr><th>Year<th>Sum<tr><td>1999<td>12</table><p>{prose}</p></div><div><h3>Latest</h3><ul><li><a href=3>Some other headline</a></ul></div></div><div>Imprint 2020</div></body>"
    assert html_extract.main_text(page) == f"Title {prose} Part {prose} short item second item Year Sum 1999 12 {prose}"
    assert html_extract.main_text(page, 1e9) == "" and html_extract.main_text("<a href=x>only a link</a>") == "only a link"


def brute_bootstrap(graph, total):
    """Scores of a pattern-instance graph, by plain dictionaries: graph maps (side, gram, instance) to (seed, places)."""
    by = defaultdict(list)
    for (side, gram, instance), (seed, places) in graph.items():
        by[side, gram].append((instance, seed, places))
    able = {p: v for p, v in by.items() if len(v) >= pii.MIN_SUPPORT and any(s for _, s, _ in v) and any(s < 2 for _, s, _ in v)}
    worth = {i: float(s > 0) for v in able.values() for i, s, _ in v}
    seeds = dict(worth)
    trust = {}
    for _ in range(pii.ROUNDS):
        trust = {p: sum(n * worth[i] for i, _, n in v) / (max(total[p[1]], sum(n for *_, n in v)) + 1) for p, v in able.items()}
        best = {i: [max((t for p, t in trust.items() if p[0] == side and any(x[0] == i for x in able[p])), default=0.0) for side in (0, 1)] for i in worth}
        worth = {i: 1.0 if seeds[i] else 1 - (1 - a) * (1 - b) for i, (a, b) in best.items()}
    return {(p[0], p[1], i) for p, v in able.items() for i, s, _ in v if s < 2 and trust[p] >= pii.ACCEPT and worth[i] >= pii.ACCEPT}


def test_op4_graph_scores_by_brute_force(spark):
    rng = random.Random(8)
    pool = ["badge", "code", "the", "of", "my", "Token", "=", "number:", "is"]
    ident = lambda: rng.choice(["+1 555 555 %04d" % rng.randrange(30), "x%d@mail.org" % rng.randrange(30), "AB%06d" % rng.randrange(20), "77-%05d-Q" % rng.randrange(9), '"%040x"' % (rng.randrange(9) + (10 << 152))])
    rows = [(i, " ".join(ident() if rng.random() < 0.15 else rng.choice(pool) for _ in range(40))) for i in range(60)]
    rows += [(100 + i, f"please send badge code {ident()} now") for i in range(40)] + [(200 + i, 'login token = "%040x" ok' % (i + (11 << 152))) for i in range(8)]
    rows += [(300, 'login token = "zebra-2024-key" ok'), (301, None), (302, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    graph = pii.edges(pii.find(docs, ["doc_id"]))
    plain = {(r.side, r.gram, r.instance): (r.seed, r.places) for r in graph.collect()}
    grams = {k[1] for k in plain}
    counted = {r.gram: r.total for r in pii.occurrences(docs, graph.select("gram").distinct()).collect()}
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower())] for _, t in rows]
    assert sum(counted.values()) > 0 and set(counted) <= grams
    once = spark.createDataFrame([(" ".join(w[i : i + n]), w[i : i + n]) for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1)], "s string, w array<string>")
    by_hand = Counter(r.gram for r in once.selectExpr("case size(w) when 1 then xxhash64(w[0]) when 2 then xxhash64(w[0], w[1]) else xxhash64(w[0], w[1], w[2]) end as gram").collect())
    # n-grams that run over a text's end count with fewer words, as they do in xxhash64 of nulls
    assert all(counted[g] >= by_hand[g] for g in counted)
    want = brute_bootstrap(plain, defaultdict(int, counted))
    got = {(r.side, r.gram, r.instance) for r in pii.bootstrap(graph, docs).collect()}
    assert got == want and got
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[300] == 'login token = "[ID]" ok' and out[301] is None and out[302] == ""


def test_op4_long_texts(spark, tmp_path):
    rng = random.Random(9)
    rows = [(1, "1 " * 20000), (2, "a" * 100000), (3, " ".join(f"u{i}@x.org 10.0.0.{i % 300}" for i in range(3000))), (4, "a-" * 50000), (5, ("é" * 50 + " +1 555 123 4567, ") * 700), (6, " ".join(rng.choice(["4111 1111 1111 1111", "x", "1.2.3.4"]) for _ in range(3000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: ([x.n_email, x.n_ip, x.n_card, x.n_phone], x.base_sha256) for x in pii.query(spark, str(tmp_path)).collect()}
    assert got == {d: brute_pii(t) for d, t in rows}
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[5] == ("é" * 50 + " [PHONE], ") * 700 and out[2] == rows[1][1] and "@" not in out[3]


def test_op6_giants_over_tasks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("abcdetionsrhl  é🙂▁ß,.") for _ in range(n))) for i, n in enumerate((0, 10, 3000, 1999, 5000, 64, 65))] + [(20, None), (21, "ab" * 3000), (22, " " * 4000), (21, "ab" * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    figures = lambda: sorted((r.doc_id, r.ids, r.n_tokens, r.n_bytes, r.score, r.round_trip) for r in sentencepiece_scan.encode_documents(docs, ["doc_id"], check=True).collect())
    whole = figures()
    monkeypatch.setattr(sentencepiece_scan, "STRETCH", 128)
    monkeypatch.setattr(sentencepiece_scan, "GIANT", 1000)
    assert figures() == whole and all(r[-1] for r in whole)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_run(spark, tmp_path, empty):
    """run() over odd rows with columns named like the code's own, and over an empty table."""
    more = ", row int, _row long, g long, n long, _size long, _h long, kept boolean, c0 string, made int"
    rows = [] if empty else [(*r, 1, 2, 3, 4, 5, 6, False, "x", 7) for r in ROWS]
    spark.createDataFrame(rows, SCHEMA + more).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if empty:
        assert out == []
        return
    ids = Counter(r.doc_id for r in out)
    texts = {r[0]: r[1] for r in ROWS}
    assert max(ids.values()) <= 3 and not set(ids) & {300, 301, 302, 303, 304}
    assert all(r.n_tokens == len(r.ids) > 0 for r in out)
    group = {d: c for d, _, c in brute_components([r[:2] for r in ROWS if r[0] in ids])}
    assert len(set(group.values())) == len(ids) and all(texts[d] for d in ids)
