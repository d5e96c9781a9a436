import pytest

from chaintally.llm import warc_fixity as wf


FILE = 20


def replica(spark, rows, file=FILE):
    """Records (id, length, digest, ...) in files of ids; a record's place is its number among those given."""
    placed = [(r[0], r[0] // file, k, *r[1:]) for k, r in enumerate(rows)]
    return spark.createDataFrame(placed, "record_id long, file long, place long, length long, digest string, status string").repartition(3)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 300])
def test_damage_is_located(spark, n):
    first = [(i, 10 + i, f"d{i}", None) for i in range(n)]
    second = list(first)
    want = {n // 2: "changed"}
    second[n // 2] = (n // 2, 10 + n // 2, "other", None)
    if n > 10:
        second[3] = (3, 999, "d3", None)
        second = [r for r in second if r[0] not in (7, n - 1)]
        first = [r for r in first if r[0] != 5]
        want |= {3: "changed", 7: "missing", n - 1: "missing", 5: "extra"}
    got = {r.record_id: r.status for r in wf.audit(replica(spark, first), replica(spark, second), fanout=4).collect()}
    assert got == want


def test_equal_empty_and_repeated(spark):
    rows = [(i, 1, "d", None) for i in range(40)]
    a = replica(spark, rows)
    assert wf.audit(a, a).count() == 0
    assert wf.audit(a.limit(0), a.limit(0)).count() == 0
    assert wf.audit(a.limit(0), a).count() == 40
    twice = replica(spark, rows + [rows[9]])
    assert [(r.record_id, r.status) for r in wf.audit(a, twice).collect()] == [(9, "changed")]


def test_null_and_repeated_pages(spark, tmp_path):
    rows = [(None, "u", "x"), (97, None, "abc"), (98, "v", ""), (99, "w", None), (100, "z", "y"), (100, "z", "y"), (98, "v", "12"), (5, "k", "l" * 100_000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.status) for r in wf.op7_warc_fixity(spark, str(tmp_path)).collect())
    assert got == [(97, "changed"), (98, "changed"), (99, "missing"), (100, "extra"), (100, "extra")]


def test_offsets_run_through_a_file(spark):
    df = spark.createDataFrame([(i, i // 1024, 10 * (i % 7 + 1)) for i in range(3000)], "place long, file long, length long")
    got = {r.place: (r.node, r.offset) for r in wf.with_offsets(df).collect()}
    at = 0
    for i in range(3000):
        at = 0 if i % 1024 == 0 else at
        assert got[i] == (i % 1024, at)
        at += 10 * (i % 7 + 1)


def test_a_cut_out_record_is_the_only_one_reported(spark):
    """All records after it stand elsewhere in their file, with other offsets, and are the same records."""
    rows = [(i, 10 + i % 5, f"d{i}", None) for i in range(400)]
    for cut, file in ((0, 400), (57, 100), (399, 400), (200, 1)):
        second = [r for r in rows if r[0] != cut]
        assert [tuple(r) for r in wf.audit(replica(spark, rows, file), replica(spark, second, file), 4).collect()] == [(cut, "missing")]
        assert [tuple(r) for r in wf.audit(replica(spark, second, file), replica(spark, rows, file), 4).collect()] == [(cut, "extra")]


def test_only_differing_files_are_descended(spark, monkeypatch):
    rows = [(i, 10, f"d{i}", None) for i in range(800)]
    second = [r if r[0] != 333 else (333, 10, "other", None) for r in rows]
    seen = {}
    differing = wf._differing

    def counted(one, two, keys, name):
        seen.setdefault(name, []).append((one.count(), two.count()))
        return differing(one, two, keys, name)

    monkeypatch.setattr(wf, "_differing", counted)
    assert [tuple(r) for r in wf.audit(replica(spark, rows), replica(spark, second), 4).collect()] == [(333, "changed")]
    # forty files of twenty records: no comparison sees more than the children of one node
    assert all(max(pair) <= 8 for pairs in seen.values() for pair in pairs)


def test_a_lost_file_and_moved_records(spark):
    rows = [(i, 10, f"d{i}", None) for i in range(60)]
    lost = [r for r in rows if r[0] // FILE != 1]
    assert sorted(tuple(r) for r in wf.audit(replica(spark, rows), replica(spark, lost), 4).collect()) == [(k, "missing") for k in range(20, 40)]
    turned = rows[:20][::-1] + rows[20:]
    assert wf.audit(replica(spark, rows), replica(spark, turned), 4).count() == 0


def test_the_offset_range_is_in_the_leaf(spark):
    rows = [(i, 10, "same", None) for i in range(8)]
    a, b = (wf.tree(replica(spark, r), 2, [1], 4, "t") for r in (rows, rows[:3] + [(3, 11, "same", None)] + rows[4:]))
    hashes = [{r.node: r.hash for r in t[1][0].collect()} for t in (a, b)]
    assert [k for k in range(8) if hashes[0][k] != hashes[1][k]] == [3, 4, 5, 6, 7]
    assert {(r.node, r.start, r.end) for r in a[1][1].collect()} == {(0, 0, 40), (1, 40, 80)}
