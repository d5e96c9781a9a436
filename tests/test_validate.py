"""Rule tables, reject reasons and the quality report on hand-made lines."""

from chaintally.operators.validate import (
    contract_rules,
    keep_valid,
    quality_report,
    reason_counts,
    tx_gas_only,
    tx_recipient,
    tx_value_time,
)
from chaintally.schemas import TRANSACTION_FIELDS
from chaintally.sources.lines import with_fields

SAMPLE = ("0x01f7583ce239ad19682ccbadb21d69a03cf7be333f4be9c02233874e3f79bf9d,0,"
          "0x9b430b5151969097fd7e5c29726a3afe680ab56f0f14a49a8f045b66392add15,46400,0,"
          "0xf55cdbdf978f539ea4eee0621f7f1a0f9f00f7d9,0x6baf48e1c966d16559ce2dddb616ffa72004851e,"
          "5000000000000000,21000,500000000000,0x,1438922527,,,0")


def tx(**changes):
    f = SAMPLE.split(",")
    for k, v in changes.items():
        f[TRANSACTION_FIELDS.index(k)] = v
    return ",".join(f)


def reasons(df, rules):
    return {r.reason: r.n for r in reason_counts(with_fields(df), rules).collect()}


def test_sample_line_is_valid(lines):
    assert reasons(lines([SAMPLE]), tx_value_time()) == {"ok": 1}


def test_damaged_lines_get_first_failing_reason(lines):
    rows = [
        ",".join(TRANSACTION_FIELDS),              # header: value text does not parse
        SAMPLE.rsplit(",", 1)[0],                   # 14 fields
        SAMPLE + ",extra",                          # 16 fields
        tx(value="value"), tx(value="nan"), tx(value="1_000"),
        tx(block_timestamp="x"), tx(value="5.7"), tx(value="1e18"),
    ]
    got = reasons(lines(rows), tx_value_time())
    assert got == {"number:value": 4, "arity": 2, "integer:block_timestamp": 1, "ok": 2}


def test_empty_recipient_kept_for_months_rejected_for_totals(lines):
    df = lines([tx(to_address="")])
    assert reasons(df, tx_value_time()) == {"ok": 1}
    assert reasons(df, tx_recipient()) == {"empty:to_address": 1}
    assert reasons(df, tx_recipient(exact=True)) == {"empty:to_address": 1}


def test_exact_rule_rejects_fraction(lines):
    df = lines([tx(value="5.7"), tx(value="1e18"), tx()])
    assert reasons(df, tx_recipient()) == {"ok": 3}
    assert reasons(df, tx_recipient(exact=True)) == {"integer:value": 2, "ok": 1}


def test_lenient_rule_keeps_wrong_arity_with_recipient(lines):
    short_with_to = ",".join(SAMPLE.split(",")[:10])          # 10 fields, field 6 present
    very_short = ",".join(SAMPLE.split(",")[:5])              # no field 6: rejected
    wrong_no_to = tx(to_address="") + ",x"                     # 16 fields, empty recipient
    full_no_to = tx(to_address="")                             # 15 fields pass either way
    df = lines([short_with_to, very_short, wrong_no_to, full_no_to])
    assert keep_valid(with_fields(df), tx_gas_only(lenient=True)).count() == 2
    assert keep_valid(with_fields(df), tx_gas_only(lenient=False)).count() == 1


def test_quality_report_adds_up(lines):
    rows = [SAMPLE, SAMPLE, tx(value="v"), SAMPLE.rsplit(",", 1)[0]]
    rep = quality_report(with_fields(lines(rows)), tx_value_time()).collect()
    assert {r.reason: r.n for r in rep} == {"ok": 2, "number:value": 1, "arity": 1}
    assert {(r.lines, r.kept, r.dropped) for r in rep} == {(4, 2, 2)}


def test_contract_rules_naive_and_quoted(lines):
    header = "address,bytecode,function_sighashes,is_erc20,is_erc721,block_number"
    rows = [header, "0xa,0x60,,False,False,1", "0xb,0x60,0x2ef9db13,False,False,",
            '0xc,0x60,"0x2ef9db13,0xe3767876",False,False,', ",0x60,,False,False,"]
    df = lines(rows)
    assert reasons(df.select("value"), contract_rules()) == {"header": 1, "ok": 2, "arity": 1, "empty:address": 1}
    quoted = {r.reason: r.n for r in reason_counts(with_fields(df, "quoted"), contract_rules()).collect()}
    assert quoted == {"header": 1, "ok": 3, "empty:address": 1}


def test_numbers_that_do_not_fit_are_rejected(lines):
    """Means and totals only see values that are there."""
    from chaintally.plans import ledger as L
    rows = [tx(value="100"), tx(value="300"), tx(value="9" * 78)]
    assert reasons(lines(rows), tx_value_time()) == {"ok": 2, "number:value": 1}
    assert [(r.n, r.avg_value) for r in L.monthly_value(lines(rows)).collect()] == [(2, 200.0)]
    assert [r.total_value for r in L.recipient_totals(lines(rows)).collect()] == [400]
    assert L.global_mean_gas(lines([tx(gas="10"), tx(gas="9" * 40)])).first().avg_gas == 10.0
    times = [tx(block_timestamp=t) for t in ("9" * 20, "9" * 18, "1500000000000")] + [tx()]
    assert reasons(lines(times), tx_value_time()) == {"ok": 1, "integer:block_timestamp": 1, "range:block_timestamp": 2}
    assert [r.month for r in L.monthly_value(lines(times)).collect()] == ["2015/08"]


def test_a_sum_beyond_38_digits_is_null_and_first(lines):
    from chaintally.plans import ledger as L
    big = "9" * 32
    rows = [tx(to_address="0xa", value=big)] * 3 + [tx(to_address="0xb", value="5")]
    contracts = lines(["0xa,0x60,,False,False,1", "0xb,0x60,,False,False,1"])
    assert [(r.address, r.total_value) for r in L.top_contracts(lines(rows), contracts).collect()] == [("0xa", None), ("0xb", 5)]
