"""The ledger of the input contract against plain counts, and against what the calculation sums."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayledger.operators.contract import Lines, input_contract, key_rules, line_rules, service_needs
from stayledger.operators.lines import with_tax
from stayledger.operators.lookup import Lookup
from tests.frames import TAX, books, frame, line


def ledger(frame_):
    return {(r["table_name"], r["rule"]): (r["rows"], r["amount"]) for r in frame_.collect()}


def test_keys(spark):
    pick = random.Random(1)
    rows = [(pick.choice([1, 2, 3, None]), pick.choice(["a", "b", None])) for _ in range(200)]
    got = ledger(key_rules(spark.createDataFrame(rows, "x long, y string").repartition(4), "t", ["x", "y"]))
    whole = Counter(r for r in rows if None not in r)
    assert got == {("t", "repeated key"): (sum(n - 1 for n in whole.values()), 0.0), ("t", "key missing"): (sum(None in r for r in rows), 0.0)}
    assert set(ledger(key_rules(spark.createDataFrame([], "x long"), "t", ["x"])).values()) == {(0, 0.0)}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("typed", [True, False])
def test_amounts_add_up_to_what_is_summed(spark, small, typed):
    pick = random.Random(2)
    hotel = [
        line(pick.choice([1, None]), pick.randrange(9), code=pick.choice(["0", "8", "7", None]), kind=pick.choice(["I", "J"]), venta=pick.choice([None, 10.25, 3.5]))
        for _ in range(300)
    ]
    given = books(spark, {"hotel": hotel}, tax=[*TAX, TAX[0]], small=small)
    pairs = spark.createDataFrame([(1, n) for n in range(6)] + [(1, 0)], "operative_incoming long, booking_id long")
    got = ledger(line_rules(Lines(given.lines, "seq_rec", "seq_reserva", "imp_venta", service_needs(typed)), "service", given.tax, Lookup(pairs, small)))

    codes = {(t[0], t[1]) for t in TAX}
    def reason(rec, res, code, kind):
        if not any(c == code and (kind == k or not typed) for k, c in codes):
            return "no sales tax row"
        if (kind, code) not in codes:
            return "no purchase tax row"
        return "lines summed" if rec == 1 and res < 6 else "no booking"

    wanted = {rule: [0, Decimal(0)] for rule in ("lines read", "lines summed", "no sales tax row", "no purchase tax row", "no booking")}
    for row in hotel:
        rec, res, *_ = row
        for rule in ("lines read", reason(rec, res, row[9], row[8])):
            wanted[rule][0] += 1
            wanted[rule][1] += Decimal(str(row[4] or 0))
    assert got == {("service", rule): (n, float(amount)) for rule, (n, amount) in wanted.items()}
    read, summed = got["service", "lines read"], got["service", "lines summed"]
    dropped = [got["service", rule] for rule in wanted if rule.startswith("no ")]
    assert read[0] - summed[0] == sum(n for n, _ in dropped) and read[1] - summed[1] == pytest.approx(sum(a for _, a in dropped))

    # What the calculation itself sums, once the repeated key is taken out.
    once = Lookup(given.tax.frame.distinct(), small)
    kept = with_tax(given.lines, once, typed).join(pairs.distinct(), (F.col("seq_rec") == F.col("operative_incoming")) & (F.col("seq_reserva") == F.col("booking_id")))
    assert kept.agg(F.count(F.lit(1)), F.coalesce(F.sum("imp_venta"), F.lit(0.0))).first() == summed


def test_all_tables_in_one_ledger(spark):
    given = books(spark)
    pairs = Lookup(spark.createDataFrame([], "operative_incoming long, booking_id long"), True)
    tables = {"tax": (frame(spark, "tax", [*TAX, TAX[0]]), ["ind_tipo_imp", "cod_impuesto"])}
    lines = {"cost": Lines(given.costs, "grec_seq_rec", "rres_seq_reserva", "imp_unitario")}
    got = ledger(input_contract(tables, lines, given.tax, pairs))
    assert got["tax", "repeated key"] == (1, 0.0) and got["cost", "lines read"] == (0, 0.0) and len(got) == 5
