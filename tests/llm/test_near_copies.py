import numpy as np

from framewright.llm import near_copies


def sets_of(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute_force(rows):
    """doc_id -> least id reachable over pairs of similarity 0.8 or more."""
    sets = [sets_of(t) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, m in shared.items():
            if m >= 0.8 * (len(s) + len(sets[j]) - m):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def rows_with_edits(spark, sf):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for i, (_, text) in enumerate(rows[:150]):
        words = (text or "").split()
        for j in rng.integers(0, max(len(words), 1), len(words) // 40):  # similarity of about 0.78
            words[j] = f"other{j}"
        rows.append((10**6 + i, " ".join(words)))
    return rows + [(2 * 10**6, None), (2 * 10**6 + 1, " "), (2 * 10**6 + 2, "two words"), (2 * 10**6 + 3, "Two  words")]


def test_near_copies_equal_brute_force(spark, sf):
    rows = rows_with_edits(spark, sf)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_force(rows)
    assert got == want and sum(d != r for d, r in want.items()) > 30


def test_stage_removes_near_copies_only(spark, sf):
    import corpus_pipeline

    rows = rows_with_edits(spark, sf)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()}
    assert kept == {d for d, r in brute_force(rows).items() if d == r}


def test_no_rows(spark):
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def edited(n, words, share, seed):
    """n texts of one text with a share of its words replaced."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    return [(i, " ".join(f"o{i}x{j}" if rng.random() < share else x for j, x in enumerate(base))) for i in range(n)]


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    """Rounds of a few partners each leave few pairs; all at once were 34,207."""
    verify, made = near_copies._alike, []

    def counted(pairs, sets, least):
        made.append(pairs.count())
        return verify(pairs, sets, least)

    monkeypatch.setattr(near_copies, "_alike", counted)
    rows = edited(600, 150, 0.012, 5)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows) and max(made) < 30 * len(rows), made


def test_candidates_come_from_simhash_too(spark, monkeypatch):
    """Without any band in common, fingerprints within three bits still meet."""
    import corpus_pipeline
    from framewright.llm import simhash

    rows = edited(1, 2_000, 0, 1) + [(i + 1, t) for i, t in edited(3, 2_000, 0.0006, 2)] + [(9, "something else that stands for itself")]
    bits = [simhash.fingerprint(t) for _, t in rows]
    assert all(0 < (bits[0] ^ x).bit_count() <= 3 or x == bits[0] for x in bits[:4])
    monkeypatch.setattr(near_copies, "BANDS", 1)
    monkeypatch.setattr(near_copies, "_apart", lambda keys, roots: keys.join(roots, "node").limit(0))
    plain = near_copies.signatures

    def alone(docs, *args):
        from pyspark.sql import functions as F

        return plain(docs, *args).withColumn("bands", F.array("node"))

    monkeypatch.setattr(near_copies, "signatures", alone)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert kept == {0, 9}


def test_groups_of_few_pairs_need_no_rounds(spark, monkeypatch):
    """Rounds over groups whose texts are mostly below the similarity took more
    rows than all pairs do, and more of them the larger the table was."""
    plain, turns = near_copies._some, []

    def counted(rows, turn, least):
        turns.append(turn)
        return plain(rows, turn, least)

    monkeypatch.setattr(near_copies, "_some", counted)
    rows = [(100 * g + i, t.replace("w", f"g{g}w")) for g in range(8) for i, t in edited(10, 150, 0.02, g)]
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows) and not turns
    assert any(d != r for d, r in got.items()) and len(set(got.values())) > 8


def test_shingles_of_the_same_texts_are_one_row(spark):
    sets = spark.createDataFrame([(1, 100, list(range(100))), (2, 100, list(range(100))), (3, 100, list(range(90)) + list(range(200, 210)))], "node long, n int, shingles array<long>")
    rows = near_copies._prefixes(sets.selectExpr("node", "node as root"), sets, 0.8).collect()
    # 10 shingles of nodes 1 and 2 alone and 11 of 90 that all hold; node 3's own 10 come before
    assert sorted((r.node, r.w, r.left, r.short) for r in rows) == [(1, 10, 100, True), (1, 11, 90, True), (2, 10, 100, True), (2, 11, 90, True), (3, 11, 90, True)]


def test_sketches_differ_in_no_more_cells_than_sets(spark):
    rng = np.random.default_rng(8)
    for n in (1, 7, 150, 5_000):
        for changed in {0, 1, n // 5, n}:
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            x = near_copies.sketches(np.concatenate([a, b]), np.cumsum([0, len(a), len(b)]))
            cells, most = np.bitwise_count(x[0] ^ x[1]).sum(), len(np.setxor1d(a, b))
            assert cells <= most and (most > 100 or cells >= 0.8 * most)


def test_texts_below_the_similarity_make_few_pairs(spark, monkeypatch):
    """Texts of one text, most of them too far from each other: they share its
    rare shingles, and all that did were compared in full."""
    verify, made = near_copies._alike, []

    def counted(pairs, sets, least):
        made.append(pairs.count())
        return verify(pairs, sets, least)

    monkeypatch.setattr(near_copies, "_alike", counted)
    rows = edited(400, 150, 0.035, 7)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows) and 1 < len(set(got.values())) < 400
    assert len(made) == 2 and made[1] < 3 * len(rows), made


def test_rounds_alone_link_the_same(spark, monkeypatch):
    """Each round joins the prefixes with the roots once."""
    monkeypatch.setattr(near_copies, "FEW", 0)
    plain, turns = near_copies._some, []

    def counted(rows, turn, least):
        turns.append(turn)
        assert {"root", "sketch"} <= set(rows.columns) and "Join" not in rows._jdf.queryExecution().toString()
        return plain(rows, turn, least)

    monkeypatch.setattr(near_copies, "_some", counted)
    rows = edited(150, 150, 0.015, 6)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows) and turns
