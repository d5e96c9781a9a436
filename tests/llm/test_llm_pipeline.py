import importlib
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from chaintally.llm import decontaminate as dc
from chaintally.llm import mixing, secrets, simhash_dedup, toxicity
from chaintally.llm.common import dense_index, stage, table
from chaintally.session import checkpoint_root
from test_llm_decontaminate import plain as plain_hits
from test_llm_mixing import plain_taken, plain_targets
from test_llm_simhash import plain_components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_pipeline(spark, docs, benchmark, model):
    """The five stages in plain Python over lists of rows; the toxicity model's weights are given."""
    weights, bias = toxicity.model_weights(model)

    def toxic(text):
        z, worded = toxicity.sentence_logits((text or "").encode(), weights, bias)
        p = 1 / (1 + 2.718281828459045 ** -z[worded])
        heard = p[z[worded] >= model.floor]
        return max(1 - float((1 - heard).prod()), p.max(initial=0)) >= 0.5

    rows = [r for r in docs if not toxic(r[1])]
    parts = {}
    for r, (_, _, c) in zip(sorted(rows, key=lambda r: str(r[0])), sorted(plain_components([(r[0], r[1], None) for r in rows]))):
        parts.setdefault(c, []).append(r)
    rows = [next(r for r in group if str(r[0]) == c) for c, group in parts.items()]
    out = []
    for r in rows:
        n, hit, _ = plain_hits(r[1], benchmark, 10)
        if hit and len(hit) == n:
            continue
        text, size = r[1], r[4]
        if hit:
            places = [m.span() for m in __import__("re").finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
            kept, at = "", 0
            for k in hit:
                if k - 1 not in hit:
                    kept += text[at:places[k][0]]
                at = places[k][1]
            text = kept + text[at:]
            size = len(text)
        out.append((r[0], text, r[2], r[3], size))
    spoken = Counter(w for r in out for w in secrets.corpus_words((r[1] or "").encode()))
    frequent = sorted((w for w, n in spoken.items() if n >= secrets.WORD_SHARE * spoken.total()), key=lambda w: (-spoken[w], w))
    guesser = secrets.Guesser([*secrets.COMMON, *(w.decode() for w in frequent)])
    clean = [r[1] and secrets.masked(r[1], "[SECRET]", guesser) for r in out]
    out = [(*r[:1], c, *r[2:4], r[4] if c == r[1] else len(c)) for r, c in zip(out, clean)]
    sizes = {}
    for r in out:
        sizes[r[3]] = sizes.get(r[3], 0) + len(simhash_dedup.words((r[1] or "").encode()))
    target = plain_targets(sizes)
    return sorted((r for r in out for _ in range(plain_taken(r, target[r[3]] / sizes[r[3]] if sizes[r[3]] else 0))), key=str)


def test_pipeline_matches_plain_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == COLUMNS
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.learn(docs, labels, F.lit(True))
    benchmark = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    want = plain_pipeline(spark, [tuple(r) for r in docs.select(*COLUMNS).collect()], benchmark, model)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


CLASHES = ("spans", "items", "n_words", "__hash", "row_hash", "no_id", "id", "nth", "__id", "__rate", "rate", "of_source", "drawn", "times", "copy",
           "__source", "toxic_score", "offending", "fp", "size", "lang_pred")


def test_stages_keep_the_values_of_clashing_columns(spark, tmp_path):
    """What a document's own columns hold leaves every stage as it came, whatever they are called."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    texts = [None, "", "some words here now ok", "long text " * 20_000, "token = abcdefghijkl", "a planted benchmark passage of ten words in this text here, and more"]
    rows = [(k, t, "en", "s", len(t or ""), *[f"{c}-{k}" for c in CLASHES]) for k, t in enumerate(texts)]
    rows += rows[2:3] + [(None, "no id", "en", None, None, *[None] * len(CLASHES))]
    spark.createDataFrame([(1, "a planted benchmark passage of ten words in this text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, schema)
    for name, step in corpus_pipeline.STAGES:
        before = {(r.doc_id, *r[5:]) for r in docs.collect()}
        docs = stage(step(spark, docs, str(tmp_path)), f"clash-{name}")
        after = [(r.doc_id, *r[5:]) for r in docs.collect()]
        assert docs.columns == [*COLUMNS, *CLASHES] and after and set(after) <= before
    assert any(r.doc_id == 5 and "planted" not in r.text for r in docs.collect())


def test_operators_replace_columns_of_their_names_only(spark):
    rows = [(1, "token = abcdefghijkl and words", "mine", 7, "x", "y", 0.5, None), (2, None, None, 8, None, "z", None, "keep")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_words long, __hash string, other string, toxic_score double, items string")
    bench = spark.createDataFrame([(1, "never found")], "item_id long, text string")
    own = [c for c in docs.columns if c not in ("spans", "n_words", "items", "toxic_score")]
    for found in (dc.find_contamination(docs, bench), secrets.find_secrets(docs), toxicity.score(docs, toxicity.train([(b"a", 0)]))):
        assert sorted(tuple(r[c] for c in own) for r in found.collect()) == sorted(tuple(r[c] for c in own) for r in docs.collect())


def test_stages_keep_columns_and_take_edge_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, __id long"
    rows = [(1, None, None, None, None, "a", 1), (2, "", "en", "s", 0, None, None), (2, "", "en", "s", 0, None, None), (None, "some words here now ok", "en", None, 3, "b", 2),
            (3, "long text " * 20_000, "en", "s", 200_000, None, 3), (4, "token = abcdefghijkl", "en", "t", 20, None, None)]
    spark.createDataFrame([(1, "never found words in here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, str(tmp_path)), f"edge-{name}")
            assert docs.columns == [f.split()[0] for f in schema.split(", ")]
        assert bool(docs.count()) == bool(part)


def test_dense_index_numbers_rows_in_order(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("(id * 7919) % 1000 as k", "id")
    rows = dense_index(df, ["k", "id"], "t").collect()
    by_number = sorted(rows, key=lambda r: r["index"])
    assert [r["index"] for r in by_number] == list(range(5000))
    assert [(r.k, r.id) for r in by_number] == sorted((r.k, r.id) for r in rows)
    assert dense_index(df.limit(0), ["k"], "t").count() == 0


@pytest.mark.parametrize("name", ["op1_mix_sources", "op5_topk_search", "op7_warc_fixity"])
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = db.execute(__spark_entry__.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = __spark_entry__.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(map(tuple, want.fetchall()), key=str)


def test_contract_columns(spark):
    types = {
        "op1": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
        "op2": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op4": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        "op5": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
        "op6": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
        "op8": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
        "op9": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
        "op10": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
        "op11": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
                 "near_edited": "double", "near_next": "double"},
        "op12": {"conv_id": "bigint", **dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint"), "audit": "string",
                 "repaired_sha256": "string"},
        "op13": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    }
    known = __spark_entry__.queries()
    found = {k.split("_")[0]: k for k in known if k.startswith("op") and k[2].isdigit()}
    assert len(found) == 13 and "pipeline" in known
    for op, columns in types.items():
        got = dict(known[found[op]](spark, SF).dtypes)
        assert {c: got.get(c) for c in columns} == columns


def test_entry_without_the_subpackage(monkeypatch):
    gone = {m: None for m in sys.modules if m.startswith("chaintally.llm") or m == "corpus_pipeline"}

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("chaintally.llm") or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for m in gone:
        monkeypatch.delitem(sys.modules, m)
    import chaintally
    monkeypatch.delattr(chaintally, "llm", raising=False)
    monkeypatch.setattr(sys, "meta_path", [Missing(), *sys.meta_path])
    entry = importlib.reload(__spark_entry__)
    assert not [k for k in entry.queries() if k == "pipeline" or (k.startswith("op") and k[2].isdigit())]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_run_leaves_only_the_last_result(spark, monkeypatch):
    """What the stages staged, and the results between, are deleted as soon as the next one is written."""
    staged = []

    def twice(spark, docs, sf_dir):
        staged.append(stage(docs.limit(7), "within"))
        assert staged[-1].count() == 7
        return staged[-1].union(staged[-1])

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", twice), ("second", twice)])
    found = corpus_pipeline.run(spark, SF)
    assert found.count() == 14 and found.columns == COLUMNS
    folders = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
    assert len(folders) == 1 and "pipeline-second" in folders.pop()
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    assert not [p for p in root.glob("staged-*") if p.name.startswith(("staged-within", "staged-pipeline-first"))]
