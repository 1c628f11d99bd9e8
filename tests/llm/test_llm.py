"""The operators against brute force, round trips and held-out labels, and on odd input."""

import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barsignal.llm import (
    bigru, components, decontaminate, embedding_dedup, hnsw, html_text, language, line_dedup, minhash, packing, quality,
    token_output, tokens, toxicity, words,
)
from barsignal.llm.common import prepare
from barsignal.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hits string, score string, `gone` int"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
BASE = " ".join(f"tok{i}" for i in range(60))
NEAR = BASE.replace("tok30", "other")
VOCAB = tokens.vocabulary_file()


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    texts = [None, "", "   \n \n", LONG, BASE, NEAR, BASE, BASE.upper() + " x", "Short one.", "éß 中文 \U0001f600", BASE + "\n" + BASE]
    rows = [(i if i != 8 else None, t, "en" if i % 2 else None, "s", len(t or ""), "h", "c", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], rows[0]], DOCS)


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


def oracle_components(ids, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and near(a, b) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


# Words and tokens ---------------------------------------------------------

def test_word_hashes_depend_on_the_word_alone():
    text = b"one two  one\nthree\ttwo one"
    h = words.word_hashes(text, "space")
    assert h[0] == h[2] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 3
    many = " ".join(f"w{i}" for i in range(50_000)).encode()
    assert len(set(words.word_hashes(many, "space").tolist())) == 50_000


@pytest.mark.parametrize("text", [
    "", "a  b", "\n\nx", "İstanbul. İ. Σας. ΣΑΣ, x", "é. café, <|endoftext|>. don't. it's, a.b ...",
    "Hello\tworld\r\n foo.,", " x y.", "́abc. ́", "1234, 5.", "ǅ. ﬁ. ½, ². µ. ", BASE, LONG[:5000],
])
def test_chunks_give_the_tokenizers_ids(text):
    coder = tokens.ChunkEncoder(VOCAB)
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):  # from the memory the second time
        assert np.frombuffer(coder.batch([text])[0], coder.dtype).tolist() == want


def test_small_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 50)
    coder = tokens.ChunkEncoder(VOCAB)
    texts = [" ".join(f"x{i % 300}," for i in range(s, s + 400)) for s in range(0, 900, 100)]
    got = coder.batch(texts[:4]) + coder.batch(texts[4:])
    assert [np.frombuffer(g, coder.dtype).tolist() for g in got] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


# Components ---------------------------------------------------------------

def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 160)] + [tuple(map(int, rng.integers(200, 300, 2))) for _ in range(60)]
    ends = sorted({x for a, b in edges for x in (a, b) if a != b})
    pairs = {frozenset(e) for e in edges}
    want = oracle_components(ends, lambda a, b: frozenset((a, b)) in pairs)
    got = components.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 1 Line dedup -------------------------------------------------------------

def brute_lines(rows, least):
    """The rule word for word: a window, or a window with the lines up to one beside it, that has stood before."""
    seen, gone = set(), {k: set() for k, _ in rows}
    for k, text in rows:
        own = [(i, s.strip(" "), s.strip(" ").count(" ") + 1) for i, s in enumerate((text or "").split("\n")) if s.strip(" ")]

        def words(a, b):
            return sum(x[2] for x in own[a:b])

        for s in range(len(own)):
            e = next((e for e in range(s + 1, len(own) + 1) if words(s, e) >= least), None)
            if e is None:
                break
            content = tuple(x[1] for x in own[s:e])
            runs = [(("window", content), own[s:e])]
            for a in range(s - 1, -1, -1):
                if words(a, s) > least:
                    break
                runs.append((("left", content, tuple(x[1] for x in own[a:s])), [own[a]]))
            for b in range(e, len(own)):
                if words(e, b) > least:
                    break
                runs.append((("right", content, tuple(x[1] for x in own[e : b + 1])), [own[b]]))
            for run, lines in runs:
                if run in seen:
                    gone[k].update(x[0] for x in lines)
            seen.update(run for run, _ in runs)
    return gone


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    pool = [" ".join(f"l{i}w{j}" for j in range(int(rng.integers(1, 9)))) for i in range(25)]
    rows = [(d, "\n".join(str(x) for x in rng.choice([*pool, "", " "], int(rng.integers(0, 25))))) for d in range(40)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), 12).collect()}
    want = brute_lines(rows, 12)
    assert any(want.values())
    for d, t in rows:
        assert got[d].n_removed == len(want[d])
        assert got[d].text == ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[d]) if want[d] else t)


def test_line_dedup_finds_passages_inside_other_text(spark):
    passage = "\n".join(" ".join(f"p{i}q{j}" for j in range(9)) for i in range(6))
    rows = [(1, "alpha\n" + passage + "\nbeta"), (2, "gamma delta\n" + passage), (3, "clean text\nof its own")]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "gamma delta", 3: rows[2][1]}


def test_line_dedup_on_odd_rows(odd, none):
    got = line_dedup.line_dedup(odd)
    assert got.count() == odd.count() and set(odd.columns) < set(got.columns)
    rows = {(r.doc_id, r.n_chars): r for r in got.collect()}
    assert rows[0, 0].text is None and rows[2, 6].n_lines == 0 and rows[6, len(BASE)].text == ""
    assert line_dedup.line_dedup(none).count() == 0


# 2 Decontamination --------------------------------------------------------

def test_decontamination_recall_and_exactness(spark):
    rng = np.random.default_rng(5)
    names = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(names, int(rng.integers(10, 50))))) for i in range(60)]
    index = decontaminate.BenchmarkIndex(items)
    missed = 0
    for i, t in items:
        w = t.split()
        for _ in range(decontaminate.allowed(len(w))):
            at = int(rng.integers(len(w)))
            w[at : at + int(rng.integers(2))] = [str(rng.choice(names))] if rng.random() < 0.7 else []
        text = " ".join([*rng.choice(names, 30), *w, *rng.choice(names, 30)])
        hits = index.search([text])[0]
        missed += i not in {h[0] for h in hits}
        assert all(h[3] <= decontaminate.allowed(len(items[h[0]][1].split())) for h in hits)
    assert missed <= 2
    clean = [" ".join(rng.choice(names, 200)) for _ in range(50)]
    assert not any(index.search(clean))


def test_decontamination_queries(spark, odd, none):
    item = "The quick brown fox jumps over the lazy dog, again and again."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, item), (5, "tok1 tok2")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "see: the QUICK brown fox jumps over a lazy dog again and again!"), (2, "the quick dog"), (3, None)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.edits) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 1): (1, 1), (1, 4): (1, 1)}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()} == {2, 3}
    left = decontaminate.decontaminate(odd, bench)
    assert left.columns == odd.columns and left.where("hits = 'h'").count() == left.count() > 0
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert decontaminate.decontaminate(odd, bench.limit(0)).count() == odd.count()
    blocks = decontaminate.with_hits(docs, bench, per_block=1)
    assert {(r.doc_id, h.item_id) for r in blocks.collect() for h in r.hits} == set(got)


# 3, 4 Packing and token files ---------------------------------------------

def first_fit(sizes, room):
    space = []
    for x in sorted(sizes, reverse=True):
        at = next((i for i, s in enumerate(space) if s >= x), None)
        if at is None:
            space.append(room - x)
        else:
            space[at] -= x
    return len(space)


def test_bins_against_first_fit_and_bound():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes = rng.integers(1, 60, 40).tolist()
        bins = packing.complete_bins({x: sizes.count(x) for x in sizes}, 60)
        used = sorted(x for times, pattern in bins for x in pattern * times)
        assert used == sorted(sizes) and all(sum(p) <= 60 for _, p in bins)
        assert max(-(-sum(sizes) // 60), sum(x > 30 for x in sizes)) <= sum(t for t, _ in bins) <= first_fit(sizes, 60)
    assert packing.complete_bins({6: 2, 5: 2, 4: 2, 3: 2, 2: 1}, 10)
    assert packing.complete_bins({}, 10) == []


def check_packing(rows, ids):
    at, per = {}, {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
        per.setdefault((r.doc_id, r.ids_crc32), 0)
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    return len(at)


def test_packing_and_files_on_odd_rows(odd, none):
    coder = tokens.encoder(VOCAB)
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    ids = [(d, coder.tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in texts]
    packed = packing.pack(packing.token_pieces(odd, VOCAB))
    rows = packed.collect()
    assert check_packing(rows, ids) == -(-sum(len(i) + 1 for _, i in ids) // packing.CAPACITY)
    want = sorted((d or -1, k // 2048, zlib.crc32(np.array((i + [0])[k : k + 2048], "<u4").tobytes())) for d, i in ids for k in range(0, len(i) + 1, 2048))
    assert sorted((-1 if r.doc_id is None else r.doc_id or -1, r.piece, r.ids_crc32) for r in rows) == want
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert sum(len(r.ids) for r in whole.values()) == 2 * sum(len(i) + 1 for _, i in ids)
    assert packing.pack(packing.token_pieces(none, VOCAB)).count() == 0
    index = token_output.token_files(odd, VOCAB)
    read = sorted(token_output.read_tokens(index).collect(), key=lambda r: r.start)
    order = sorted(((d is not None, d or 0, t is not None, t or ""), i + [2]) for (d, t), (_, i) in zip(texts, ids, strict=True))
    assert [list(r.ids) for r in read] == [i for _, i in order]
    assert [r.start for r in read] == np.cumsum([0, *(len(i) for _, i in order[:-1])]).tolist()
    assert token_output.read_tokens(token_output.token_files(none, VOCAB)).count() == 0


def test_files_are_read_in_place(tmp_path):
    path = str(tmp_path / "a b" / "x.arrow")
    out = token_output.SequenceWriter(path, np.dtype("<u2"), 8, 2)
    values = np.arange(100, dtype="<u2")
    assert [out.append(values[:3].tobytes()), out.append(values[3:61].tobytes()), out.append(values[61:].tobytes())] == [0, 3, 61]
    out.close()
    reader = token_output.SequenceReader(path)
    for place in (0, 5, 15, 16, 60):
        assert reader.tokens(place, 30).tolist() == list(range(place, place + 30))
    ids, mask = reader.batch(6)
    assert ids.shape == (1, 8) and mask.sum() == 4 and not ids.flags.writeable
    with pytest.raises(ValueError):
        reader.tokens(98, 5)


# 5 Toxicity ---------------------------------------------------------------

def test_gradient(monkeypatch):
    monkeypatch.setattr(bigru, "F32", np.float64)
    p = bigru.init(1, 1, 3, 4, 0)
    rng = np.random.default_rng(1)
    x, mask, y = rng.normal(0, 1, (5, 6, 3)), (rng.random((5, 6)) < 0.8).astype(float), np.array([1, 0, 1, 1, 0.0])
    _, g, dx = bigru.gradient(p, x, mask, y)
    for name in ("w", "bias", "u0", "u1", "attend", "out", "base"):
        at = tuple(int(rng.integers(s)) for s in p[name].shape)
        was = p[name][at]
        p[name][at] = was + 1e-5
        up = bigru.gradient(p, x, mask, y)[0]
        p[name][at] = was - 1e-5
        down = bigru.gradient(p, x, mask, y)[0]
        p[name][at] = was
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-6, name


@pytest.fixture(scope="module")
def marked():
    rng = np.random.default_rng(6)
    names = [f"n{i}a" for i in range(400)]
    rows = []
    for k in range(400):
        w = list(rng.choice(names, int(rng.integers(5, 150))))
        if k % 3 == 0:
            w[int(rng.integers(len(w)))] = str(rng.choice(["awfulone", "nastytwo"]))
        rows.append((" ".join(w), int(k % 3 == 0)))
    return rows


def test_toxicity_on_held_out_texts(spark, marked, odd, none):
    model = toxicity.fit_toxicity(marked[:300])
    p = model.score([t for t, _ in marked[300:]])
    assert ((p >= 0.3) == np.array([y for _, y in marked[300:]])).mean() > 0.95
    long = " ".join([*["n5a"] * 5000, "awfulone", *["n6a"] * 5000])
    assert model.score([long])[0] > 0.3 > model.score(["n7a n8a"])[0]
    assert np.allclose(model.score([None, "", "..."]), model.score([""])[0])
    assert np.allclose(model.score([marked[0][0], long])[0], model.score([marked[0][0]])[0], atol=1e-5)
    assert toxicity.with_toxicity(odd, model).where("score between 0 and 1").count() == odd.count()
    assert toxicity.with_toxicity(none, model).count() == 0
    plain = toxicity.fit_toxicity([])
    assert 0 <= plain.score(["x"])[0] <= 1


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 8, 9, 31, 32, 33, 56, 57, 500):
        starts = toxicity.window_starts(n)
        assert starts[0] == 0 and starts[-1] + toxicity.WINDOW >= n


# 6 Embeddings -------------------------------------------------------------

def test_near_vectors_equal_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(7)
    rows = []
    for label in (0, 1):
        centres = rng.normal(0, 1, (12, 16))
        for c in centres:
            rows += [(c + rng.normal(0, 0.12, 16), label) for _ in range(int(rng.integers(1, 25)))]
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0], None), (np.zeros(16), 0), (np.full(16, np.nan), 0), (rows[0][0][:8], 0)]
    data = [(i, [float(np.float32(x)) for x in v], y) for i, (v, y) in enumerate(rows)] + [(9000, None, 0), (9001, [None, 1.0], 0), (9002, [], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(df, shard=40).collect()}
    fine = {i: np.array(v) / np.linalg.norm(v) for i, v, y in data if i is not None and v and y is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: y for i, _, y in data}

    def near(a, b):
        return a in fine and b in fine and label[a] == label[b] and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= 0.98

    ids = [i for i, _, _ in data if i is not None]
    want = oracle_components(ids, near)
    links = {i: sum(near(i, j) for j in ids if j != i) for i in ids}
    found = sum(got[i].n_links for i in ids)
    assert all(got[i].n_links <= links[i] for i in ids) and found >= 0.99 * sum(links.values()) > 0
    assert sum(got[i].component_id != want[i] for i in ids) <= 0.01 * len(ids)
    assert got[None].component_id is None and got[None].kept
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, _ = hnsw.Graph(x).search(x[:200], 40)
    truth = np.argsort(-x[:200] @ x.T, 1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids.tolist(), truth.tolist(), strict=True)]) > 0.9


# 7 Pages ------------------------------------------------------------------

def test_page_markup():
    page = (
        '<html><head><title>t</title><style>p{}</style></head><body><nav><a>menu</a></nav><div class="site-header">top</div>'
        '<div class="ad_slot">buy</div><article class="has-sidebar"><h1>Head &amp; line</h1><p>One\n two<b>bold</b> &eacute;<p>Next<script>var x="</p>"</script>'
        '<form><input>go</form><div id="comments"><p>me too</p></div><p hidden>no</p><br>tail &am'
    )
    assert html_text.page_lines(page) == (["Head & line", "One twobold é", "Next", "tail &am"], True)
    assert html_text.page_lines(None) == html_text.page_lines("") == ([], False)
    assert html_text.page_lines("<p>a<!-- x --><p>b</div>c<") == (["a", "b", "c<"], False)


def test_common_lines():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 6, 12).tolist(), rng.integers(0, 6, 12).tolist()
        table = np.zeros((13, 13), int)
        for i in range(12):
            for j in range(12):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        got = html_text.common_lines(a, b)
        assert len(got) == table[-1, -1] and got == sorted(got)


def test_pages_without_article_are_differenced(spark):
    prepare(spark)

    def page(k):
        return f"<body><p>Our site</p><p>Story {k} begins</p><div>and {k} goes on</div><p>All about us</p></body>"

    rows = [(k, f"http://h.example/a/{k}", page(k)) for k in range(6)] + [(90, "http://h.example/a/0?x=1", page(0)), (91, "http://other.example/a", page(9)), (92, None, None), (93, "http://[bad", "<p>x</p>")]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert all(got[k] == f"Story {k} begins\nand {k} goes on" for k in range(6))
    assert got[90] == got[0] and got[91].startswith("Our site") and got[92] == "" and got[93] == "x"
    assert html_text.main_text(df).count() == 11 and html_text.main_text(df.limit(0)).count() == 0


# 8 Language ---------------------------------------------------------------

def test_language(spark, odd, none):
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn_language(docs)
    got = language.with_language(docs, model).where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2))
    assert got.where("lang = lang_pred").count() > 0.98 * got.count()
    rows = language.with_language(odd, model).collect()
    assert {r.lang_pred for r in rows if r.text is None or not any(c.isalpha() for c in r.text)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows) and language.with_language(none, model).count() == 0
    assert {r.lang_pred for r in language.with_language(odd, language.learn_language(none)).collect()} == {"und"}


# 9 Near duplicates --------------------------------------------------------

def test_near_duplicates_equal_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(12)
    names = [f"t{i}" for i in range(500)]
    rows = []
    for family in range(12):
        base = list(rng.choice(names, int(rng.integers(3, 120))))
        for _ in range(12):
            w = list(base)
            for _ in range(int(rng.integers(0, 6))):
                w[int(rng.integers(len(w)))] = str(rng.choice(names))
            rows.append((len(rows) * 7, "  ".join(w)))
    sets = {d: shingles(t) for d, t in rows}

    def near(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= 75 * len(sets[a] | sets[b])

    want = oracle_components(list(sets), near)
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: got[d].component_id for d in sets} == want
    assert {d: got[d].n_shingles for d in sets} == {d: len(s) for d, s in sets.items()}
    assert 12 < len(set(want.values())) < len(rows)


def test_estimates():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        values = []
        for _ in range(20):
            x = rng.integers(0, 1 << 62, 400).astype(np.uint64)
            y = x.copy()
            new = int(400 * (1 - share) / (1 + share) + 0.5)
            y[:new] = rng.integers(0, 1 << 62, new).astype(np.uint64)
            equal = (minhash.registers(np.sort(x)) == minhash.registers(np.sort(y))).mean()
            values.append(minhash.estimate(np.array([equal]), np.array([400]), np.array([400]))[0])
        assert abs(np.mean(values) - (400 - new) / (400 + new)) < 0.03


def test_near_duplicates_on_odd_rows(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows}
    assert got[0].n_shingles == got[1].n_shingles == got[2].n_shingles == 0
    assert got[5].component_id == got[6].component_id == got[7].component_id == 4 and got[None].component_id is None
    left = minhash.first_of_groups(odd)
    assert left.columns == odd.columns and {r.doc_id for r in left.collect()} == {0, 1, 2, 3, 4, 9, None} | ({10} if got[10].kept else set())
    assert minhash.near_duplicates(none).count() == 0


# 10 Quality ---------------------------------------------------------------

def test_quality_on_held_out_texts(spark, odd, none):
    rng = np.random.default_rng(9)
    names = [f"fine{i}" for i in range(200)]
    good = [(" ".join(rng.choice(names, 80)), 1) for _ in range(120)]
    bad = [("!! ".join(rng.choice(["WIN", "CASH", "###", "$$$"], 80)), 0) for _ in range(120)]
    model = quality.fit_quality(good[:80] + bad[:80])
    assert min(model.score([t for t, _ in good[80:]])) > 0.3 > max(model.score([t for t, _ in bad[80:]]))
    assert quality.with_quality(odd, model).where("score between 0 and 1").count() == odd.count()
    assert quality.with_quality(none, model).count() == 0
    assert 0 < quality.fit_quality([]).score([""])[0] < 1


# Queries and pipeline -----------------------------------------------------

def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES and set(SQL) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline_against_brute_force(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    text = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        rows = left.collect()
        assert left.columns == docs.columns and len({r.doc_id for r in rows}) == len(rows)
        before, text = text, {r.doc_id: r.text for r in rows}
        assert name == "quality classifier" or set(text) <= set(before)
        if name == "line dedup":
            gone = brute_lines(sorted(before.items()), line_dedup.MIN_WORDS)
            assert all(len((before[d] or "").split("\n")) - len((t or "").split("\n")) in (len(gone[d]), len(gone[d]) - 1) for d, t in text.items())
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "minhash near-dedup":
            sets = {d: shingles(t) for d, t in before.items()}
            want = oracle_components(list(sets), lambda a, b: sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
            assert set(text) == {d for d, c in want.items() if c == d}
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(text)
    check_packing(packed, None)
