"""The published questions on small fixtures, checked against plain Python."""

import json
from decimal import Decimal

from chaintally.operators.rank import best_row, pivot_series, zero_fill
from chaintally.plans import ledger as L
from chaintally.sources.registry import parse_registry

from test_validate import tx

DAY = 86400
AUG15 = 1438922527          # 2015/08
SEP15 = AUG15 + 40 * DAY    # 2015/09


def tx_rows():
    return [
        tx(to_address="0xa", value="100", gas="21000", gas_price="5", block_timestamp=str(AUG15)),
        tx(to_address="0xa", value="300", gas="50000", gas_price="7", block_timestamp=str(SEP15)),
        tx(to_address="0xb", value="250", gas="90000", gas_price="9", block_timestamp=str(SEP15)),
        tx(to_address="0xc", value="250", gas="10000", gas_price="1", block_timestamp=str(SEP15)),
        tx(to_address="", value="999", gas="30000", gas_price="3", block_timestamp=str(AUG15)),
        tx(to_address="0xd", value="bad", gas="g", gas_price="3", block_timestamp=str(AUG15)),
    ]


def test_monthly_value(lines):
    got = {r.month: (r.n, r.avg_value) for r in L.monthly_value(lines(tx_rows())).collect()}
    assert got == {"2015/08": (2, (100 + 999) / 2), "2015/09": (3, (300 + 250 + 250) / 3)}


def test_monthly_gas(lines):
    got = {r.month: (r.avg_gas, r.avg_gas_price) for r in L.monthly_gas(lines(tx_rows())).collect()}
    assert got == {"2015/08": ((21000 + 30000) / 2, (5 + 3) / 2), "2015/09": (50000.0, 17 / 3)}


def contracts():
    return ["0xa,0x60,,False,False,1", "0xb,0x60,0x1,False,False,2", '0xc,0x60,"0x1,0x2",False,False,3',
            "0xb,0x60,0x1,False,False,2"]


def test_top_contracts_modes_and_tie_break(lines):
    t, c = lines(tx_rows()), lines(contracts())
    quoted = [(r.address, r.total_value) for r in L.top_contracts(t, c, k=3).collect()]
    assert quoted == [("0xa", Decimal(400)), ("0xb", Decimal(250)), ("0xc", Decimal(250))]
    naive_bag = [(r.address, r.total_value) for r in L.top_contracts(t, c, k=10, csv_mode="naive", bag=True).collect()]
    assert naive_bag == [("0xa", Decimal(400)), ("0xb", Decimal(250)), ("0xb", Decimal(250))]


def test_top_miners_and_overhead(lines, spark):
    def block(n, miner, size, h="0x" + "a" * 64):
        f = [str(n), "0xh", "0xp", "0x0", h, "0x" + "0" * 512, h, h, h, miner, "1", "2", size,
             "0x", "8", "1", "1438922527", "1", ""]
        return ",".join(f)
    rows = [block(1, "m1", "10"), block(2, "m2", "30"), block(3, "m1", "25"), block(4, "", "99"),
            block(5, "m3", "x"), "number,hash"]
    top = [(r.miner, r.total_size) for r in L.top_miners(lines(rows)).collect()]
    assert top == [("m1", 35), ("m2", 30)]
    hexes = L.block_hex_frame(lines(rows))
    cols = {r.column: r.bits for r in L.overhead_columns(hexes, ["sha3_uncles", "logs_bloom"]).collect()}
    assert cols == {"sha3_uncles": 5 * 256, "logs_bloom": 5 * 2048}
    total = L.overhead_total(hexes, ["sha3_uncles", "logs_bloom", "transactions_root", "state_root", "receipts_root"]).first()
    assert total.total_bits == 5 * (4 * 256 + 2048)
    assert abs(total.total_gb - total.total_bits * 1.25e-10) < 1e-12


def test_above_below_mean(lines):
    out = {r.address: (r.avg_gas, r.side) for r in L.above_below_mean(lines(tx_rows()), lines(contracts()), k=2).collect()}
    overall = (21000 + 50000 + 90000 + 10000 + 30000) / 5
    assert out == {"0xa": (35500.0, "below"), "0xb": (90000.0, "above")}
    assert L.global_mean_gas(lines(tx_rows())).first().avg_gas == overall


def test_mean_equal_to_global_counts_as_above(lines):
    rows = [tx(to_address="0xa", gas="100"), tx(to_address="0xb", gas="100")]
    out = L.above_below_mean(lines(rows), lines(["0xa,0x60,,False,False,1"]), k=5).collect()
    assert [(r.address, r.side) for r in out] == [("0xa", "above")]


def registry_lines(lines):
    doc = {"result": {
        "0xa": {"id": 1, "category": "Phishing", "addresses": ["0xa", "0xb"]},
        "0xb": {"id": 1, "category": "Phishing", "addresses": ["0xa", "0xb"]},
        "0xc": {"id": 2, "category": "Scamming", "addresses": ["0xc"]},
        "0xz": {"id": 3, "category": "Fake ICO", "addresses": []},
    }}
    return parse_registry(lines([json.dumps(doc)], 1))


def test_top_scams_set_and_bag(lines):
    t, reg = lines(tx_rows()), registry_lines(lines)
    set_mode = {r.scam_id: int(r.total_value) for r in L.scam_id_totals(t, reg).collect()}
    bag_mode = {r.scam_id: int(r.total_value) for r in L.scam_id_totals(t, reg, dedupe=False).collect()}
    assert set_mode == {"1_Phishing": 650, "2_Scamming": 250}
    assert bag_mode == {"1_Phishing": 1300, "2_Scamming": 250}
    assert all(set_mode[k] <= bag_mode[k] for k in set_mode)
    best = best_row(L.scam_id_totals(t, reg), "scam_id", "total_value").first()
    assert (best.scam_id, best.total_value) == ("1_Phishing", "650")


def test_scam_monthly_fill_and_pivot(lines, spark):
    t, reg = lines(tx_rows()), registry_lines(lines)
    monthly = L.scam_monthly(t, reg)
    got = {(r.month, r.category): int(r.total_value) for r in monthly.collect()}
    assert got == {("2015/08", "Phishing"): 100, ("2015/09", "Phishing"): 550,
                   ("2015/09", "Scamming"): 250}
    filled = {(r.month, r.category): int(r.total_value)
              for r in zero_fill(monthly, "month", "category", "total_value").collect()}
    assert filled[("2015/08", "Scamming")] == 0 and len(filled) == 4
    totals = {r.category: int(r.total_value) for r in L.scam_category_totals(monthly).collect()}
    assert totals == {"Phishing": 650, "Scamming": 250}
    wide = pivot_series(zero_fill(monthly, "month", "category", "total_value"), "month", "category",
                        "total_value", ["Phishing", "Scamming", "Fake ICO"]).orderBy("month").collect()
    assert [(r.month, r.Phishing, r.Scamming, r["Fake ICO"]) for r in wide] == [
        ("2015/08", "100", "0", None), ("2015/09", "550", "250", None)]


def test_zero_fill_spans_gaps(spark):
    s = spark.createDataFrame([("2017/05", "A", 1), ("2017/09", "A", 2), ("2018/01", "B", 3)],
                              "month string, category string, total_value bigint")
    got = zero_fill(s, "month", "category", "total_value").collect()
    assert len(got) == 2 * 9
    assert sum(r.total_value for r in got) == 6
    months = sorted({r.month for r in got})
    assert months[0] == "2017/05" and months[-1] == "2018/01" and "2017/12" in months


def test_partition_count_does_not_change_answers(lines):
    one = sorted(L.monthly_value(lines(tx_rows(), 1)).collect())
    seven = sorted(L.monthly_value(lines(tx_rows(), 7)).collect())
    assert one == seven
    t1, t7 = lines(tx_rows(), 1), lines(tx_rows(), 7)
    r1 = sorted(L.scam_monthly(t1, registry_lines(lines)).collect())
    r7 = sorted(L.scam_monthly(t7, registry_lines(lines)).collect())
    assert r1 == r7


def test_hot_address_holding_a_third_of_all_rows(lines):
    """One recipient gets a third of the transactions; sums stay exact and
    equal to a brute-force count."""
    rows, expected = [], defaultdict_int()
    for i in range(300):
        to = "0xhot" if i % 3 == 0 else f"0x{i % 17:02d}"
        value = 10 ** 18 + i
        ts = AUG15 + (i % 5) * 40 * DAY
        rows.append(tx(to_address=to, value=str(value), block_timestamp=str(ts)))
        expected[to] += value
    t = lines(rows, 6)
    contracts = lines([f"{a},0x60,,False,False,1" for a in expected])
    top = [(r.address, r.total_value) for r in L.top_contracts(t, contracts, k=3).collect()]
    best = sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert top == [(a, Decimal(v)) for a, v in best]
    doc = {"result": {"0xhot": {"id": 9, "category": "Scamming", "addresses": ["0xhot"]}}}
    reg = parse_registry(lines([json.dumps(doc)], 1))
    monthly = L.scam_monthly(t, reg).collect()
    assert sum(int(r.total_value) for r in monthly) == expected["0xhot"]


def defaultdict_int():
    from collections import defaultdict
    return defaultdict(int)
