from __future__ import annotations

from ledgerloom.llm import quality_model as q

TABLES = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, kept string, row int"


def test_held_out_labels(spark):
    """Junk is never trained on labels; the toxic lexicon sees half of them and is judged on the other half."""
    docs, labels = (spark.read.parquet(f"{TABLES}/{n}.parquet") for n in ("documents", "labels"))
    seen, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rows = q.score(docs, seen).join(held, "doc_id").collect()
    junk = [(r.junk_score > 0.5) == (r.quality == 0) for r in rows]
    toxic = [(r.toxic_score > 0.5) == (r.toxic == 1) for r in rows]
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(junk) >= 0.95 * len(junk)
    assert sum(toxic) >= 0.9 * len(toxic)
    assert sum(clean) >= 0.95 * len(clean)


def test_posteriors_find_accuracies():
    """Three labellers right in 95, 90 and 80 of 100 cases, on documents of which a fifth has the property."""
    right = (0.95, 0.9, 0.8)
    counts: dict[str, int] = {}
    for truth, share in ((True, 20_000), (False, 80_000)):
        for bits in range(8):
            votes, p = "", 1.0
            for i, r in enumerate(right):
                y = bool(bits >> i & 1)
                # false votes for the property are rare by construction
                hit = r if truth else 0.996
                p *= hit if y == truth else 1 - hit
                votes += "y" if y else "n"
            counts[votes] = counts.get(votes, 0) + round(share * p)
    post, shares = q.posteriors(counts)
    assert post["yyy"] > 0.99 and post["nnn"] < 0.01
    assert all(abs(shares[1, i, 0] - r) < 0.03 for i, r in enumerate(right))
    assert q.posteriors({})[0] == {}


def test_odd_rows_and_empty_table(spark):
    fine = "some quiet words about nothing in particular that nobody minds"
    rows = [(1, None), (2, ""), (3, fine), (3, fine), (None, fine), (4, "###*** " * 30000), (5, "you idiot and worthless clown " + fine)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 1), (9, None, None), (9, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = q.score(df, labels)
    assert got.columns == ["doc_id", "p_junk", "p_toxic", "junk_score", "toxic_score", "kept"]
    kept = {(r.doc_id, r.kept) for r in got.collect()}
    assert kept == {(1, True), (2, True), (3, True), (None, True), (4, False), (5, False)}
    assert q.score(df.limit(0), labels.limit(0)).count() == 0
