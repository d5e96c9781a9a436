"""Sources and sinks: splitting modes, typed readers, registry, saved results."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from chaintally.operators.registry import registry_addresses, registry_entries, registry_report
from chaintally.session import staging_path
from chaintally.sources.export import parse_export, scan_transactions
from chaintally.sources.lines import split_line
from chaintally.sources.registry import parse_registry, scan_registry
from chaintally.sources.results import newest, read_pair_keys_raw, read_pair_result, read_rows, save_rows, save_top_pairs

from test_validate import SAMPLE, tx


def test_split_modes(lines):
    df = lines(['a,"b,c",d', "a,,", 'x,"say ""hi"", ok",z'], 1)
    got = df.select(F.col("value"), split_line("value", "naive").alias("n"),
                    split_line("value", "quoted").alias("q")).collect()
    by = {r.value: (r.n, r.q) for r in got}
    assert by['a,"b,c",d'] == (["a", '"b', 'c"', "d"], ["a", "b,c", "d"])
    assert by["a,,"] == (["a", "", ""], ["a", "", ""])
    assert by['x,"say ""hi"", ok",z'][1] == ["x", 'say "hi", ok', "z"]


def test_typed_transactions_and_reject_lane(spark, lines):
    header = "hash,nonce,block_hash,block_number,transaction_index,from_address,to_address,value,gas," \
             "gas_price,input,block_timestamp,max_fee_per_gas,max_priority_fee_per_gas,transaction_type"
    path = staging_path(spark, "typed-tx")
    lines([header, SAMPLE, tx(value="5.7"), tx(to_address=""), tx(value="9" * 78)], 1).write.text(path)
    typed = scan_transactions(spark, path).collect()
    assert len(typed) == 2
    row = [r for r in typed if r.to_address][0]
    assert row.value == Decimal(5000000000000000) and row.gas == 21000 and row.block_timestamp == 1438922527
    assert row.max_fee_per_gas is None and row.transaction_type == 0
    rejects = scan_transactions(spark, path, with_rejects=True).groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rejects} == {"header": 1, None: 2, "wei:value": 2}


def test_typed_contracts_quoted_and_naive(lines):
    rows = ["0xa,0x60,,False,False,1", "0xb,0x60,0x2ef9db13,True,False,",
            '0xc,0x60,"0x2ef9db13,0xe3767876",False,False,']
    quoted = parse_export(lines(rows), "contracts").collect()
    assert {r.address: r.function_sighashes for r in quoted} == {
        "0xa": [], "0xb": ["0x2ef9db13"], "0xc": ["0x2ef9db13", "0xe3767876"]}
    assert {r.address: r.is_erc20 for r in quoted}["0xb"] is True
    naive = parse_export(lines(rows), "contracts", csv_mode="naive").collect()
    assert sorted(r.address for r in naive) == ["0xa", "0xb"]


def test_many_quotes_take_linear_time(lines):
    """A damaged line of 20,000 quote pairs lands in the reject lane."""
    damaged = "0xd,0x60," + '"0x1",' * 20_000 + ",False,False,"
    odd = '0xe,0x60,"never closed,False,False,'
    df = lines([damaged, odd, '0xc,0x60,"0x1,0x2",False,False,'], 1)
    got = {r.reject_reason: r.n for r in parse_export(df, "contracts", with_rejects=True).groupBy("reject_reason").agg(
        F.count("*").alias("n")).collect()}
    assert got == {None: 1, "arity": 2}


def test_typed_and_rule_sets_agree_on_shared_fields(lines):
    """A field that is no number, or does not fit its type, is refused by the typed source and by the rules alike."""
    from chaintally.operators.validate import keep_valid, tx_gas, tx_recipient_time
    from chaintally.sources.lines import with_fields

    cases = [("value", t) for t in ("9" * 78, "value", "nan", "1_000", " 7", "+5", "5.7")]
    cases += [("block_timestamp", t) for t in ("9" * 20, "9" * 18, "1500000000000", "x", " 1438922527", "+1")]
    rows = [tx(**{k: t}) for k, t in cases]
    typed = {r.value: r.reject_reason is None for r in
             parse_export(lines(rows), "transactions", with_rejects=True, wide=True).toDF(*[f"c{i}" for i in range(15)], "reject_reason", "value").collect()}
    ruled = {r.value for r in keep_valid(with_fields(lines(rows)), tx_recipient_time()).collect()}
    assert {r for r, ok in typed.items() if ok} == ruled
    assert tx(value="9" * 78) in ruled
    gas = [tx(gas=t) for t in ("9" * 40, "g", " 21000 ", "+7", "1_0")]
    kept = {r.value for r in keep_valid(with_fields(lines(gas)), tx_gas()).collect()}
    assert kept == {r.hash and r.value for r in parse_export(lines(gas), "transactions", with_rejects=True).toDF(
        "hash", *[f"c{i}" for i in range(1, 15)], "reject_reason", "value").where("reject_reason is null").collect()}


def registry_doc():
    return {"result": {
        "0x1": {"id": 130, "category": "Phishing", "addresses": ["0x1"]},
        "0x2": {"id": "5622", "category": "Scamming", "addresses": ["0x2", "0x3"]},
        "0x3": {"id": "5622", "category": "Scamming", "addresses": ["0x2", "0x3"]},
        "0x4": {"id": 7, "category": "Fake ICO", "addresses": []},
    }}


def test_registry_json_one_line(spark, lines):
    path = staging_path(spark, "registry")
    lines([json.dumps(registry_doc())], 1).write.text(path)
    entries = registry_entries(scan_registry(spark, path))
    assert entries.count() == 4
    assert {r.id for r in entries.collect()} == {"130", "5622", "7"}     # numbers read as text
    members = registry_addresses(entries).collect()
    assert len(members) == 5                                             # empty list: no rows
    assert {r.scam_id for r in members} == {"130_Phishing", "5622_Scamming"}
    again = registry_entries(parse_registry(lines([json.dumps(registry_doc())], 1)))
    assert sorted(again.collect()) == sorted(entries.collect())


def test_registry_reject_lane(lines):
    ok = {"id": 1, "category": "Phishing", "addresses": ["0xa"]}
    docs = ['{"result":{"0x1":{"id":1,"cat', json.dumps({"result": {"0x2": {"id": 2, "addresses": ["0xb"]}, "0x3": ok}}),
            json.dumps({"result": {"0x4": {"category": "Scamming", "addresses": ["0xc"]}}}),
            json.dumps({"result": {"0x5": {"id": 5, "category": "Fake ICO"}}}),
            '{"result":{"0x6":{"id":6,"category":"OLD","addresses":["0xo"]},"0x6":{"id":6,"category":"NEW","addresses":["0xn"]}}}',
            "not json", "", '{"other": 1}']
    registry = parse_registry(lines(docs))
    assert {r.reason: r.n for r in registry_report(registry).collect()} == {"ok": 3, "json": 3, "id": 1, "category": 1}
    entries = registry_entries(registry)
    assert {(r.entry_address, r.id, r.category) for r in entries.collect()} == {
        ("0x3", "1", "Phishing"), ("0x5", "5", "Fake ICO"), ("0x6", "6", "NEW")}   # a repeated key: the last counts
    assert {(r.address, r.scam_id) for r in registry_addresses(entries).collect()} == {("0xa", "1_Phishing"), ("0xn", "6_NEW")}


def test_saved_rows_come_back_as_numbers(spark):
    df = spark.createDataFrame([("2015/08", 85609, 4.8052118459597475e20, Decimal("5.700000")), ("a\"b,[", 0, 0.0, Decimal("0.000000")),
                                ("c", -3, 1.5, None)], "m string, n long, v double, d decimal(38,6)")
    path = staging_path(spark, "rows")
    save_rows(df, path)
    back = read_rows(spark, path, "m string, n long, v double, d decimal(38,6)")
    assert sorted(back.collect()) == sorted(df.collect())
    published = staging_path(spark, "published")
    spark.createDataFrame([('[["2015/08", 85609, 4.8052118459597475e+20], ["2015/09", 173805, 7.04e+19]]',)], "value string").write.text(published)
    assert [(r.m, r.n, r.v) for r in read_rows(spark, published, "m string, n long, v double").collect()] == [
        ("2015/08", 85609, 4.8052118459597475e20), ("2015/09", 173805, 7.04e19)]
    for line in spark.read.text(newest(spark, path)).collect():
        assert len(json.loads(line.value)) == 4


def test_pair_result_roundtrip_keeps_big_integers(spark):
    df = spark.createDataFrame(
        [("5622_Scamming", Decimal("16709083588073530571339")), ("2135_Phishing", Decimal("6583972305381559340034")),
         ("90_Phishing", Decimal("5972589629102419738989"))], "k string, v decimal(38,0)")
    path = staging_path(spark, "pairs")
    save_top_pairs(df, path, "k", "v", [F.col("v").desc(), F.col("k")], 2)
    text = spark.read.text(newest(spark, path)).first().value
    assert json.loads(text) == [["5622_Scamming", 16709083588073530571339], ["2135_Phishing", 6583972305381559340034]]
    back = read_pair_result(spark, path).orderBy("rank").collect()
    assert [(r.rank, r.key, Decimal(r.value)) for r in back] == [
        (1, "5622_Scamming", Decimal("16709083588073530571339")), (2, "2135_Phishing", Decimal("6583972305381559340034"))]
    keys = read_pair_keys_raw(spark, path).orderBy("rank").collect()
    assert [r.key for r in keys] == ["5622_Scamming", "2135_Phishing"]


def test_int_overflow_goes_to_reject_lane(lines):
    rows = [tx(transaction_type="99999999999"), tx(transaction_type="2"), tx(transaction_type="")]
    typed = parse_export(lines(rows), "transactions").collect()
    assert sorted((r.transaction_type is None, r.transaction_type) for r in typed) == [(False, 2), (True, None)]


def test_wide_amounts_are_kept_as_text(lines):
    rows = lines([tx(value="9" * 78, gas_price="+" + "0" * 50 + "7"), tx(value="x")])
    assert [(r.value, r.gas_price) for r in parse_export(rows, "transactions", wide=True).collect()] == [("9" * 78, "7")]
    assert parse_export(rows, "transactions").collect() == []


def test_every_field_is_parsed_once(spark, lines):
    """One pattern per number field in the executed plan, whether rejects are asked for or not."""
    from chaintally.sources.export import LAYOUTS

    numbers = sum(f.base in ("long", "time", "int", "wei") for f in LAYOUTS["transactions"])
    for rejects in (False, True):
        df = parse_export(lines([tx()]), "transactions", with_rejects=rejects)
        spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
        try:
            planned = df._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.debug.maxToStringFields")
        assert planned.count("RLIKE") == numbers


def test_one_document_of_200_000_entries(spark, lines):
    """The entries stream out of the document's binary form: no map of them is in the plan, and a repeated key's last entry counts."""
    n = 200_000
    entry = '"0x%040x":{"id":%d,"category":"Scamming","addresses":["0x%040x","0x%040x"]}'
    doc = '{"result":{' + ",".join(entry % (k, k % 1000, k, k + 1) for k in range(n)) + ',"0x%040x":{"id":"last","category":"Phishing"}}}' % 7
    registry = parse_registry(lines([doc, '{"result":', '{"result":7}', '{"other":{}}', '{"result":{}}'], 1))
    entries = registry_entries(registry)
    assert "map<" not in entries._jdf.queryExecution().optimizedPlan().toString()
    got = entries.agg(F.count("*").alias("n"), F.countDistinct("entry_address").alias("d"), F.sum(F.size("addresses")).alias("a"),
                      F.max(F.when(F.col("id") == "last", F.col("category"))).alias("last")).first()
    assert (got.n, got.d, got.a, got.last) == (n, n, 2 * (n - 1), "Phishing")
    assert registry_addresses(entries).where("address is not null").count() == 2 * (n - 1)
    assert {r.reason: r.n for r in registry_report(registry).collect()} == {"ok": n, "json": 3}
