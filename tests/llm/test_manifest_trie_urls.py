"""The Merkle manifest, the prefix trie and the URL filter against plain versions, over many ranges and on odd rows."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hexspark.llm import common, merkle, queries, trie, url_filter

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


@pytest.fixture
def ranges(spark):
    """Small tables in seven ranges, not in one."""
    names = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


# ---- Merkle


def _said(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def _plain_manifest(rows):
    """(key, leaf, subroot, root, path) of every row, sorted."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0], H(*map(_said, r))))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            out.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
            i //= 3
        return out

    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, leaf in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]) for s in sources}
    crown = tree([trees[s][-1][0] for s in sources])
    out = []
    for at, s in enumerate(sources):
        keys = [k for k, _ in sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
        for i, k in enumerate(keys):
            out.append((str(k), trees[s][0][i], trees[s][-1][0], crown[-1][0], path(trees[s], i) + path(crown, at)))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("height", [1, 2, 8])
def test_proofs_equal_a_plain_tree(ranges, height):
    rng = random.Random(height)
    texts = [None, "", "a\nb", "\n", "é\n" * 5, "x" * 100_000]
    rows = [(None if rng.random() < 0.05 else rng.randint(-50, 200), "s" if rng.random() < 0.4 else rng.choice([None, "", "a", "é", "zz", "=", *map(str, range(12))]), rng.choice([None, "en"]),
             rng.choice([None, 3]), rng.choice(texts)) for _ in range(260)]
    rows += rows[:7] + [rows[0]] * 20
    docs = ranges.createDataFrame(rows, DOCS).withColumns({n: F.lit(1) for n in ("grp", "k", "leaf", "place", "total", "kept", "root", "block", "path")})
    start = merkle.tampered("text", F.replace("text", F.lit("\n"), F.lit("")))
    found = merkle.prove(docs, height=height, start=start).withColumn("again", merkle.folded(F.col("leaf"), F.col("path")))
    found = found.withColumn("spoilt", merkle.folded(F.col("start"), F.col("path"))).collect()
    got = sorted(((str(r.doc_id), r.leaf, r.subroot, r.root, [(s["at"], list(s["nodes"])) for s in r.path]) for r in found), key=str)
    assert got == _plain_manifest(rows)
    leaves = {H(*map(_said, r)): "\n" in (r[4] or "") for r in rows}
    assert all(r.again == r.root and (r.spoilt != r.root) == leaves[r.leaf] for r in found)


@pytest.mark.parametrize("rows", [[], [(1, "a", None, None, None)], [(1, "a", "en", 1, "x"), (1, "b", "en", 1, "x")]])
def test_manifest_of_few_rows(spark, rows):
    found = merkle.prove(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((str(r.doc_id), r.leaf, r.subroot, r.root, [(s["at"], list(s["nodes"])) for s in r.path]) for r in found), key=str) == _plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 81, 100, 243, 244, 2187, 3000])
def test_traversal_is_never_late_and_holds_few_nodes(n):
    leaves, levels = [H(str(i)) for i in range(n)], merkle.levels_of(n)
    walk = merkle.Traversal(leaves, levels)
    root = walk.root()
    for i in range(n):
        node = leaves[i]
        for at, nodes in walk.path():
            node = H(*nodes[:at], node, *nodes[at:])
        assert node == root
        assert sum(len(t.stack) for t in walk.coming) <= 4 * max(1, levels)
        walk.advance()
    assert walk.late == 0


# ---- trie


def _plain_trie(convs):
    """Rows of the trie of {conv: [(role, text), ...]}, from every conversation's every beginning."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = collections.defaultdict(int)
    for key in members:
        if key:
            kids[key[:-1]] += 1
    saved, leaves = collections.defaultdict(int), collections.defaultdict(int)
    for key, m in members.items():
        for d in range(len(key) + 1):
            saved[key[:d]] += (len(m) - 1) * (len(key[-1][1]) if key else 0)
            leaves[key[:d]] += not kids[key]
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), kids[k], leaves[k], saved[k], H(",".join(map(str, sorted(ends[k])))))
        for k, m in members.items()
    )


def _rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, H(f"{len(role.encode())}:{role}{text}"), (role, text)))
    own = {c: [t[3] for t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + x[h:]
    return out


def _built(spark, rows, size):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({n: F.lit(1) for n in ("conv", "t", "tok", "row", "pos", "depth", "level")})
    kept, runs = trie.numbered(df, common.Scratch(spark))
    turns, convs = trie.with_shared_starts(kept, runs, (F.crc32(F.col("conv").cast("string")) % 6).cast("int"), F.col("conv") - F.col("conv") % 100, 5)
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.build(turns, convs, size).collect())


@pytest.mark.parametrize(("size", "seed"), [(1, 1), (2, 2), (3, 3), (64, 4)])
def test_trie_equals_all_beginnings(ranges, size, seed):
    rng = random.Random(seed)
    texts = ["", None, "a", "é b", "x" * 5000]
    rows = []
    for c in [*range(100, 190), 0, 3, 205, 310, 399]:
        kind = rng.random()
        n = 40 if c == 150 else rng.randint(0, 9)
        for i in range(n):
            text = "copy" if kind < 0.4 else rng.choice(texts) if i > 1 else "hello"
            rows.append((c, rng.choice([None, i, i]), rng.choice(["user", "user", None]) if kind > 0.8 else "user", text))
    rows += rows[:5] + [(None, 1, "user", "lost")]
    want = _plain_trie(_rebuilt(rows))
    assert _built(ranges, rows, size) == want and len(want) > 100


def test_trie_of_long_copies_and_of_nothing(ranges):
    assert _built(ranges, [], 64) == []
    assert _built(ranges, [(1, None, None, None)], 64) == _plain_trie(_rebuilt([(1, None, None, None)]))
    long = [(c, i, "user", f"{i}") for c in (1, 2, 3) for i in range(150 + c)]
    rows = long + [(c, i, "user", "same") for c in range(1000, 1300) for i in range(6)]
    assert _built(ranges, rows, 16) == _plain_trie(_rebuilt(rows))


# ---- URLs


def _plain_rule(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[3:] if fits else (None, None))


@pytest.mark.parametrize("most", [url_filter.MOST_RULES, 0])
def test_rules_equal_brute_force_and_the_model_decides_the_rest(ranges, most):
    rng = random.Random(5)
    hosts = ["Example.ORG", "org", "a.example.org", "notexample.org", "x.com", "com", "b.x.net", "", ".org", "é.com", "cheap-pills.example.net", "example.org:8080"]
    paths = ["", "/", "/es/a", "/en/1", "/en/12/b", "/fr/", "/de/x", "?/fr/", "#/de/", "/EN/1", "/en/1\n2", "/" + "a" * 100_000]
    urls = [rng.choice(["http://", "://", "x", "HTTP://u@", "a://b://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(300)] + [None, "", "://"] * 3
    rules = [*queries.RULES, ("x.net", "/", "allow"), ("b.x.net", "", "block"), ("com", "/fr/", "block"), (None, "/", "block")]
    df = ranges.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({n: F.lit(7) for n in ("host", "rule", "score", "_host", "_p", "verdict")})
    known = ranges.createDataFrame([*url_filter.labelled(), (None, 1), ("http://a/", None)], "url string, label int")
    out = url_filter.judge(df, ranges.createDataFrame(rules, "host string, path string, verdict string"), known, most_rules=most)
    got = {r.page_id: r for r in out.collect()}
    assert out.columns == ["page_id", "url", "_host", "_p", "host", "path", "rule", "verdict", "score"] and len(got) == len(urls)
    rules = rules[:-1]
    for i, u in enumerate(urls):
        host, path, rule, verdict = _plain_rule(u, rules)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or ("block" if got[i].score >= url_filter.CUT else "allow"))


def test_url_scores_equal_a_plain_sum_and_fit_meets_its_slope():
    rows = [(u.split("://")[1].split("/")[0], "/" + u.split("://")[1].split("/", 1)[1], y) for u, y in url_filter.labelled()]
    w = url_filter.fit(rows)

    def grams(x, field):
        codes = [256, *x.encode(), 256]
        out = []
        for n in url_filter.SIZES:
            for i in range(len(codes) - n + 1):
                h = n * 4 + field
                for c in codes[i : i + n]:
                    h = (h * int(url_filter._MULTIPLIER) + c) % 2**64
                out.append(int(common.mix64(np.array([h], np.uint64))[0]) >> (64 - url_filter.BITS))
        return out

    tried = [("", ""), ("a", ""), ("é.example.org", "/x"), *[r[:2] for r in rows[::40]]]
    got = url_filter.scores(pa.array([h for h, _ in tried]), pa.array([p for _, p in tried]), w)
    for (host, path), s in zip(tried, got, strict=True):
        z = float(w[-1]) + sum(float(w[g]) / len(own) ** 0.5 for own in (grams(host, 0), grams(path, 1)) for g in own)
        assert abs(s - 1 / (1 + np.exp(-z))) < 1e-5
    # At the optimum the sum of errors is zero, and the weights are the errors' mix of features over the ridge.
    p = url_filter.scores(pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), w)
    y = np.array([r[2] for r in rows])
    assert abs((y - p).sum()) < 1e-3
    own = collections.Counter(g for r, e in zip(rows, y - p, strict=True) for g in grams(r[0], 0)[:1] if abs(e) >= 0)
    g = own.most_common(1)[0][0]
    slope = sum(e * grams(r[field], field).count(g) / len(grams(r[field], field)) ** 0.5 for r, e in zip(rows, y - p, strict=True) for field in (0, 1))
    assert abs(slope / url_filter.RIDGE - w[g]) < 1e-3


def test_url_model_on_sites_left_out_and_odd_labels():
    rows = [(u.split("://")[1].split("/")[0], "/" + u.split("://")[1].split("/", 1)[1], y) for u, y in url_filter.labelled()]
    k, n = len(url_filter.AROUND), len(rows) // len(url_filter.AROUND)
    hits = []
    for part in range(8):  # sites, with all that goes around them, in eight parts
        out = [r for i, r in enumerate(rows) if i // k % 8 == part]
        w = url_filter.fit([r for i, r in enumerate(rows) if i // k % 8 != part])
        s = url_filter.scores(pa.array([r[0] for r in out]), pa.array([r[1] for r in out]), w)
        hits += [(r[2], x >= url_filter.CUT) for r, x in zip(out, s, strict=True)]
    caught, spared = np.mean([b for y, b in hits if y]), np.mean([not b for y, b in hits if not y])
    print(n, caught, spared)
    assert caught > 0.75 and spared > 0.85
    assert url_filter.scores(pa.array(["a"]), pa.array(["/"]), url_filter.fit([]))[0] == pytest.approx(0.5)
    assert url_filter.scores(pa.array(["a"]), pa.array(["/"]), url_filter.fit([("a", "/", 1)] * 8))[0] == pytest.approx(0.9)
    assert (url_filter.fit(rows[::-1]) == url_filter.fit(rows)).all()


def test_new_queries_equal_their_sql(spark, tmp_path):
    """Over odd tables: the SQL and the queries say the same."""
    import duckdb

    rng = random.Random(3)
    docs = [(i % 90, rng.choice([None, "a", "b", ""]), "en", 3, rng.choice([None, "", "x\ny", "z"])) for i in range(150)] + [(None, None, None, None, None)] * 2
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(c, i, "user", rng.choice(["a", "b", None])) for c in [0, 1, 2, 7, 100, 101, 350, -7] for i in range(rng.randint(1, 8))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("op12_merkle_manifest", "op13_prefix_trie"):
        got = queries.queries()[name](spark, str(tmp_path))
        cur = con.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in cur.description]
        assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, cur.fetchall()))
