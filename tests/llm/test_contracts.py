"""The queries themselves: their columns and plain versions of what they return, and the pipeline on odd tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from hexspark.llm import compression, quality_rules, queries

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}


def _fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def _rows(spark, name, folder=DIR):
    df = queries.queries()[name](spark, folder)
    return dict(df.dtypes), {r.doc_id: r for r in df.collect()}


def test_op1_counts_and_digests(spark):
    larger = DIR.replace("0.001", "0.01")  # the smallest tables hold no secret
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    kinds, rows = _rows(spark, "op1_find_secrets", larger)
    assert {k: kinds[k] for k in ("n_assign", "n_access", "n_hex")} == dict.fromkeys(("n_assign", "n_access", "n_hex"), "bigint") and kinds["spans"] == kinds["base_sha256"] == "string"
    order = ["assign", "access", "hex"]
    for i, t in texts.items():
        base = [("assign", m.start(), m.end()) for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 12]
        base += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base, key=lambda s: (s[1], order.index(s[0]))))
        r = rows[i]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in order)
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
    assert len(rows) == len(texts) and any(r.n_assign for r in rows.values())


def test_op2_base_rules(spark, texts):
    kinds, rows = _rows(spark, "op2_quality_rules")
    assert kinds["kept"] == kinds["base_failed"] == "boolean" and kinds["n_words"] == "bigint" and len(rows) == len(texts)
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        many = {w for w, n in collections.Counter(windows).items() if n > 1}
        covered = {k + j for k, w in enumerate(windows) if w in many for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_forest_scores_equal_a_walk_down_each_tree():
    rng = np.random.default_rng(8)
    rows = np.vstack([rng.normal(size=(400, 4)), [[9, 9, 9, 9], [0, 0, 0, 40], [np.float64(0)] * 4]])
    forest = quality_rules.Forest(rows, trees=20, size=64)
    got = forest.score(rows)

    def harmonic(n):
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    for i in (0, 7, 399, 400, 401, 402):
        length = 0.0
        for feature, cut, left, depth in forest.trees:
            at, steps = 0, 0
            while feature[at] >= 0:
                at = left[at] + (rows[i, feature[at]] >= cut[at])
                steps += 1
            assert depth[at] >= steps
            length += depth[at]
        assert got[i] == pytest.approx(2 ** (-length / 20 / harmonic(64)))
    assert got[400] > np.quantile(got, 0.99) and got[401] > np.quantile(got, 0.95) and got[402] < np.median(got)


def test_op3_base_score(spark, texts):
    kinds, rows = _rows(spark, "op3_language_model")
    assert [kinds[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")] == ["boolean", "bigint", "bigint", "bigint", "double", "double"]
    lower = {i: re.sub("[A-Z]", lambda m: m[0].lower(), t) for i, t in texts.items()}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t), None] for i, t in lower.items()}
    c = collections.Counter(w for i, ws in tokens.items() if _fold(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_fold(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) and r.score < 0


def test_op8_finds_planted_items(spark, texts):
    df = queries.queries()["op8_decontaminate"](spark, DIR)
    found = {(r.doc_id, r.item_id) for r in df.collect()}
    items = {r.item_id: r.text or "" for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()}
    whole = {(i, k) for i, t in texts.items() for k, x in items.items() if len(x.split()) >= 5 and f" {' '.join(x.split())} " in f" {' '.join(t.split())} "}
    assert whole <= found and all(i in texts and k in items for i, k in found)


@pytest.mark.parametrize(("name", "cut"), [("op9_quality_classifier", 0.3), ("op10_toxicity", 0.5)])
def test_classifier_columns(spark, texts, name, cut):
    kinds, rows = _rows(spark, name)
    assert [kinds[c] for c in ("doc_id", "held_out", "score", "predicted")] == ["bigint", "boolean", "double", "int"] and len(rows) == len(texts)
    for i, r in rows.items():
        assert r.held_out == (_fold(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= cut)


def test_op9_scores_equal_plain_compression(spark, texts):
    """Sizes of every 1 KB piece under both dictionaries, by compressors of their own."""
    docs, labels = (spark.read.parquet(f"{DIR}/{n}.parquet") for n in ("documents", "labels"))
    model = compression.trained(docs, labels, ~compression.held_out("doc_id"), "doc_id", "text")
    _, rows = _rows(spark, "op9_quality_classifier")
    for i in sorted(texts)[:60]:
        raw = texts[i].encode()
        sizes = []
        for d in (model.good, model.bad):
            total = 0
            for k in range(0, len(raw), 1024):
                plain = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
                total += len(plain.compress(raw[k : k + 1024]))
            sizes.append(total)
        x = (sizes[1] - sizes[0]) / (len(raw) + 256)
        # A prepared dictionary may match a little otherwise than a loaded one.
        assert rows[i].score == pytest.approx(1 / (1 + math.exp(-(model.slope * x + model.shift))), abs=0.05)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(20000))
ODD = [(1, None, None, None, None), (2, "", "en", "b", 0), (3, " \t\n", None, "a", 3), (4, "one", "en", "a", 3), (4, "one", "en", "a", 3), (None, "a b c d", "de", "c", 7), (5, LONG, "en", "b", 9), (6, LONG, "en", "b", 9)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_pipeline_and_queries_on_odd_tables(spark, tmp_path, rows):
    """Null, empty and very long texts, ties and repeated rows, extra columns with clashing names, and tables without rows."""
    import corpus_pipeline

    d = str(tmp_path)
    docs = spark.createDataFrame(rows, DOCS).withColumns({n: F.lit(1) for n in ("score", "_text", "size", "spans", "row", "root", "digest", "_key", "h", "component_id")})
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, 1, 1), (77, 0, 0)][: len(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, "")][: len(rows)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, "http://a.example.org/es/1", "<p>"), (2, None, None), (2, "", "x" * 300_000), (3, "no", "x" * 300_000)][: len(rows)], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    turns = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (2, None, None, None), (3, 1, "assistant", "y" * 300_000)][: len(rows)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    out = corpus_pipeline.run(spark, d)
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    assert out.columns == [*docs.columns, "mix_copies"] and len(kept) <= len(rows)
    if rows:  # of the two long copies and the two equal rows one stays at most
        assert sum(k in ((False, 5), (False, 6)) for k in kept) <= 1 and kept.count((False, 4)) <= 1
    for name, query in queries.queries().items():
        n = query(spark, d).count()
        table = {"op5": "pages", "op11": "pages", "op6": "conversations", "op13": None, "op8": None}.get(name.split("_")[0], "documents")
        if table == "conversations":
            assert n == len({t[0] for t in turns}) + 1
        elif table:
            assert n == spark.read.parquet(f"{d}/{table}.parquet").count(), name
        else:
            assert rows or n == 0
