"""Ranked lexical search, the Merkle manifest and MinHash near-duplicates, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellar.llm import lexical_search, merkle, minhash

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def oracle(sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con.execute(sql).df()


def same(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got[columns].values.tolist()), key=repr) == sorted(
        map(tuple, want[columns].values.tolist()), key=repr)


# ---------------------------------------------------------------- ranked lexical search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k=10):
    found = [(i, Counter(terms_of(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in found:
            m = 100 - 75 + (75 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                (1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms_of(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return out


def test_search_like_sql_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 37)
    monkeypatch.setattr(lexical_search, "BLOCK_ENTRIES", 2500)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 2000)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    same(lexical_search.digest(docs, items).toPandas(), oracle(lexical_search.ORACLE_SQL, "documents", "benchmark"))


def test_search_awkward_rows(spark):
    long = "filler words, " * 90000 + "needle"
    docs = [(1, "Alpha beta"), (2, "alpha BETA"), (2, "alpha BETA"), (3, None), (4, ""), (5, "?! --"), (None, "alpha beta"),
            (6, long), (7, "ünï-Code ÜNÏ"), (8, "unrelated text entirely"), (9, "beta " * 50)]
    items = [(1, "beta ALPHA alpha"), (1, "beta ALPHA alpha"), (2, "needle"), (3, ""), (4, None), (5, "code Ünï"),
             (6, "absent"), (None, "alpha"), (1, "filler")]
    left = spark.createDataFrame([(*d, 1, 2, 3, 4) for d in docs], "doc_id long, text string, n int, terms int, rank int, h int")
    right = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, score int, doc_id int")
    got = sorted(map(tuple, lexical_search.search(left, right).collect()), key=repr)
    want = ranked([d for d in docs], [i for i in items if i[1] is not None])
    assert got == sorted(want, key=repr)
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        none = lexical_search.search(a, b)
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


def test_ball_tree_bounds_and_pruning(monkeypatch):
    monkeypatch.setattr(lexical_search, "LEAF_DOCS", 12)
    rng = np.random.default_rng(3)
    width, sizes, column, impact = 400, [], [], []
    for i in range(600):
        # families of documents around a topic of their own
        mine = np.unique(np.concatenate([rng.integers(40 * (i // 60), 40 * (i // 60) + 40, 15), rng.integers(0, width, 2)]))
        sizes.append(len(mine))
        column.append(mine)
        impact.append(rng.integers(1, 10**9, len(mine)))
    sizes, column, impact = np.array(sizes), np.concatenate(column), np.concatenate(impact)
    segment = np.arange(width) % 64
    tree = lexical_search.BallTree(sizes, column, impact, width, segment)
    full = np.zeros((600, width), np.int64)
    full[np.repeat(np.arange(600), sizes), column] = impact
    below = {}

    def rows_of(node):
        leaf = tree.leaves[node]
        below[node] = leaf[0].tolist() if leaf is not None else [r for c in tree.children[node] for r in rows_of(c)]
        return below[node]

    assert sorted(rows_of(0)) == list(range(600))
    leaves, visited = sum(leaf is not None for leaf in tree.leaves), []
    for _ in range(30):
        topic = rng.integers(0, 10)
        asked = np.unique(rng.integers(40 * topic, 40 * topic + 40, 6))
        times = rng.integers(1, 4, len(asked))
        scores = full[:, asked] @ times
        bound = tree.bounds(asked, times)
        assert all(bound[node] >= scores[rows].max() for node, rows in below.items())
        search = lexical_search.Searcher([(asked, times)], 10)
        search.add(list(range(600)), sizes, column, impact, np.ones(width))
        want = [(-scores[r], False, r) for r in np.lexsort((np.arange(600), -scores))[:10] if scores[r] > 0]
        assert search.best[0] == want
        visited.append(search.visited)
    assert sum(visited) < 0.6 * 30 * leaves


# ---------------------------------------------------------------- Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree_of(leaves, fan):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + fan])) for i in range(0, len(levels[-1]), fan)])
    return levels


def path_of(levels, i, fan):
    out = []
    for level in levels[:-1]:
        begin = i // fan * fan
        out.append(("".join(level[begin:i]), "".join(level[i + 1:begin + fan])))
        i //= fan
    return out


def manifest(rows, fan):
    def leaf(row, lower):
        values = [row[0], row[1], row[2], row[3], row[4].translate(LOWER) if lower and row[4] is not None else row[4]]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, False), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_of([x[2] for x in sorted(groups[s], key=lambda x: x[:3])], fan) for s in names}
    top = tree_of([trees[s][-1][0] for s in names], fan)
    out = []
    for q, s in enumerate(names):
        for p, (_, _, digest, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = path_of(trees[s], p, fan) + path_of(top, q, fan)
            forged = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            f = leaf(row, forged)
            for a, b in path:
                f = h(a + f + b)
            out.append((row[0], digest, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in path)), f, f == top[-1][0]))
    return out


def test_tree_versions_share_what_is_untouched():
    leaves = [h(str(i)) for i in range(37)]
    tree = merkle.Tree(leaves, None, 3)
    before = (list(tree.digests), list(tree.children))
    for i in (0, 17, 36):
        made = tree.version(i, h("new"))
        changed = leaves[:i] + [h("new")] + leaves[i + 1:]
        assert tree.digests[made[-1]] == tree_of(changed, 3)[-1][0]
        # one new node a level; all other children are the tree's own
        assert len(made) == len(tree.levels)
        for level, node in enumerate(made[1:], 1):
            new = [c for c in tree.children[node] if c >= len(before[0])]
            assert new == [made[level - 1]]
    assert (tree.digests[:len(before[0])], tree.children[:len(before[0])]) == before
    assert tree.root == tree_of(leaves, 3)[-1][0]


def test_manifest_like_sql(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    same(merkle.digest(docs).toPandas(), oracle(merkle.ORACLE_SQL, "documents"))


def test_manifest_over_several_tiers(spark):
    rng = random.Random(5)
    rows = [(i, f"s{i % 3}" if i % 7 else None, "en", i, rng.choice(["Text A", "text", "", None, "É Z"])) for i in range(90)]
    rows += [(500 + i, f"t{i}", None, None, "One") for i in range(9)]
    rows += [(3, "s0", "en", 3, "again"), (3, "s0", "en", 3, "again"), (None, "s1", None, 1, "No Id"), (600, "", "x", 0, "Q")]
    rng.shuffle(rows)
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema + ", key int, digest string, n int, block int")
    text = F.col("text")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    got = merkle.manifest(df, changed, [*values, text], [*values, merkle.lowered(text)], proofs=True, block=4, fan=2).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(manifest(rows, 2), key=repr)
    for r in got:
        assert h("".join(p["left"] + p["right"] for p in r["proof"])) == r["proof_sha256"]
        # a version copies a node a level, and nothing is copied without a change
        assert (len(r["copied"]) in (0, len(r["proof"]) + 1)) and (not r["copied"] or r["copied"][-1] == r["folded_root"])
    got = merkle.digest(df).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(manifest(rows, 16), key=repr)
    assert merkle.digest(df.limit(0)).count() == 0
    (one,) = merkle.digest(df.where("doc_id = 600")).collect()
    assert one["leaf"] == one["root"] and one["proof_sha256"] == h("")


# ---------------------------------------------------------------- MinHash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 2]) for i in range(len(w) - 1)) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def near(rows):
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        return x if up[x] == x else root(up[x])

    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None), default=None)
        out.append((d, len(sets[i]), least, d == least))
    return out


def test_posterior_table():
    table = minhash.least_agreements(minhash.BANDS * minhash.ROWS)
    assert [n for n, _ in table] == list(range(25, 226, 25))
    grid = (np.arange(20000) + 0.5) / 20000
    for n, m in table[:4]:
        # P(similarity >= 0.8 | m of n agree) by numeric integration, uniform prior
        def late(k, n=n):
            p = grid ** k * (1 - grid) ** (n - k)
            return p[grid >= 0.8].sum() / p.sum()
        assert late(m) >= minhash.MISS * 0.99 and (m == 0 or late(m - 1) < minhash.MISS * 1.01)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (400, 225), dtype=np.uint8)
    same_share = rng.random((400, 225)) < np.repeat([0.82, 0.3], 200)[:, None]
    kept = minhash.survivors(x, np.where(same_share, x, rng.integers(0, 256, (400, 225), dtype=np.uint8)))
    assert kept.tolist() == list(range(200))


def test_minhash_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 8)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randint(1, 120))
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((rng.randrange(10**6), " ".join(copy)))
    # a family around one text, with members that reach the others only through some of them
    base = rng.choices(vocabulary, k=200)
    for i in range(70):
        copy = list(base)
        for _ in range(i // 4):
            copy[rng.randrange(200)] = rng.choice(vocabulary)
        rows.append((2_000_000 - i, "\t".join(copy).upper()))
    # a chain: neighbours are similar, the ends are not
    chain = rng.choices(vocabulary, k=400)
    rows += [(3_000_000 + i, " ".join(chain[3 * i:3 * i + 100])) for i in range(60)]
    rows += [(5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "ONE "), (10, "one one one"), (10, "one one one"),
             (None, "null id"), (None, "null id"), (11, "w1 " * 400000 + "end"), (12, "x" * 3_000_000), (13, "x" * 3_000_000)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id long, text string, n int, cid string, sig int, key int")
    got = sorted(map(tuple, minhash.digest(df.repartition(7)).collect()), key=repr)
    want = [(*w[:3], True) if w[0] is None and w[2] is None else w for w in near(rows)]
    assert got == sorted(want, key=repr)
    assert minhash.digest(df.limit(0)).count() == 0


@pytest.mark.parametrize("members_", [5, 300])
def test_mixed_buckets_find_all_across_components(spark, monkeypatch, members_):
    """One bucket for all: whatever the star misses is found in the second step."""
    monkeypatch.setattr(minhash, "CHUNK", 16)
    rng = random.Random(members_)
    words = [f"v{i}" for i in range(3000)]
    rows = []
    for i in range(members_):
        base = words[(i % 7) * 300:(i % 7) * 300 + 200]
        copy = list(base)
        for _ in range(4):
            copy[rng.randrange(200)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.signatures(df).where("cid IS NOT NULL").dropDuplicates(["cid"]).cache()
    ids = {bytes(r["cid"]): r["doc_id"] for r in classes.collect()}
    # all of them in the bucket of a band that all share
    alike = classes.withColumn("sig", F.concat(F.lit(b"\0" * minhash.ROWS), F.substring("sig", minhash.ROWS + 1, 1000)))
    buckets = minhash._shared_buckets(alike).where("band = 0")
    members = alike.select("cid", F.col("doc_id").alias("rep"))
    full = minhash._sets(df, members, "doc_id", "text", 2).cache()
    none = spark.createDataFrame([], "node binary, component binary")
    sets = [shingles(t) for _, t in rows]
    want = {(j, i) for i in range(members_) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}

    def found(forest):
        late = minhash._large_buckets(buckets, alike, full, 80, None if forest else none).collect()
        return {tuple(sorted((ids[bytes(r["a"])], ids[bytes(r["b"])]))) for r in late}

    def groups(links):
        up = list(range(members_))

        def root(x):
            return x if up[x] == x else root(up[x])
        for a, b in links:
            up[root(a)] = root(b)
        return [root(i) == root(j) for i in range(members_) for j in range(i)]

    assert want <= found(False)
    # one link between two components is enough, and no more come out than members of a chunk pair
    assert groups(found(True)) == groups(want) and len(found(True)) <= max(members_, 4 * members_ * members_ // 16 // 4)
    full.unpersist()
    classes.unpersist()
