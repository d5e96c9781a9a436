from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

from chaintally.llm import simhash_dedup as sd

SCHEMA = "doc_id long, text string, fp string"  # fp: an extra column with a name the operator uses


def plain_print(text):
    import re
    tokens = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + 4]) for i in range(max(1, len(tokens) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_print(t) for _, t, _ in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            group[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return sorted((str(d), p, str(ids.get(find(i)))) for i, ((d, _, _), p) in enumerate(zip(rows, prints)))


def sample_rows():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choice(words, 120)) for _ in range(25)]
    rows = [(i, t, "x") for i, t in enumerate(base)]
    for i, t in enumerate(base[:12]):
        tokens = t.split()
        tokens[int(rng.integers(120))] = "changed"
        rows.append((100 + i, " ".join(tokens), None))
    rows += [(7, base[7], "x"), (300, base[3].upper(), "y"), (301, None, None), (302, "", "x"), (303, " \t\n", "x"),
             (304, "one two", "x"), (305, "ONE  two", "x"), (None, base[4], "x"), (None, "alone by itself here now", None),
             (306, "long " * 30_000, "x")]
    return rows


def test_any_four_positions_hold_a_triple():
    triples = sd.position_triples()
    assert len(triples) == len(set(triples)) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_components_match_brute_force(spark):
    rows = sample_rows()
    got = sd.components(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fp & (2 ** 64 - 1), str(r.component_id)) for r in got) == plain_components(rows)


def test_long_posting_lists_are_dealt_without_loss(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2 ** 63, 3, dtype=np.uint64)
    prints = set(map(int, centre))
    for c in map(int, centre):
        for _ in range(80):
            bits = rng.choice(64, int(rng.integers(1, 6)), replace=False)
            prints.add(c ^ sum(1 << int(b) for b in bits))
    prints = np.array(sorted(prints), dtype=np.uint64)
    df = spark.createDataFrame([Row(fp=int(x)) for x in prints.view(np.int64)], "fp long")

    def roots(block):
        return {r.node: r.root for r in sd.connected(sd.links(df, block=block)).collect()}

    small, large = roots(8), roots(10_000)
    assert small == large
    near = {(int(a), int(b)) for a, b in combinations(prints.tolist(), 2) if (a ^ b).bit_count() <= 4}
    assert all(small[np.uint64(a).astype(np.int64)] == small[np.uint64(b).astype(np.int64)] for a, b in near)


def test_star_steps_join_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in sd.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_keep_one_keeps_whole_rows(spark):
    rows = sample_rows()
    kept = sd.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp"]
    got = kept.collect()
    components = plain_components(rows)
    assert len(got) == len({c for _, _, c in components if c != "None"}) + 1  # one group has no id at all
    assert {str(r.doc_id) for r in got} == {c for _, _, c in components}
    assert all((r.doc_id, r.text, r.fp) in rows for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sd.components(empty).count() == 0
    assert sd.keep_one(empty).count() == 0


def test_triple_keys_do_not_meet(spark):
    df = spark.createDataFrame([Row(fp=-1), Row(fp=0)], "fp long")
    keys = df.select(F.explode(sd._posting_keys(F.col("fp"))).alias("k")).distinct().count()
    assert keys == 40
