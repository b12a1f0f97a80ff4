import hashlib
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from vaultmart.functions import div_round_half_away, hash_key, hashdiff, pct_change_rounded
from vaultmart.functions.hashing import as_text


def test_hash_key_is_md5_hex_and_null_safe(spark):
    df = spark.createDataFrame([("42",), (None,)], "id string")
    got = [r[0] for r in df.select(hash_key("id")).collect()]
    assert got[0] == hashlib.md5(b"42").hexdigest()
    assert got[1] is None


def test_hashdiff_skips_nulls_and_coalesces(spark):
    df = spark.createDataFrame([("a", None, 3, None)], "x string, y string, n int, m int")
    got = df.select(hashdiff(as_text("x", True), as_text("y", True), as_text("n"),
                             as_text("m"))).first()[0]
    # coalesced '' keeps its slot, a null number is skipped by concat_ws
    assert got == hashlib.md5(b"a||||3").hexdigest()


def test_decimal_text_keeps_scale(spark):
    df = spark.createDataFrame([(Decimal("500000.00"),)], "p decimal(14,2)")
    assert df.select(as_text("p")).first()[0] == "500000.00"


def _half_away(num, den):
    return int((Decimal(num) / Decimal(den)).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def test_div_round_half_away_matches_decimal(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(-10**12, 10**12), rnd.randint(1, 10**6)) for _ in range(500)]
    pairs += [(5, 2), (-5, 2), (15, 10), (-15, 10), (0, 3), (1, 2), (-1, 2)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", div_round_half_away("n", "d").alias("q")).collect()
    for r in got:
        assert r.q == _half_away(r.n, r.d), (r.n, r.d, r.q)
    assert spark.createDataFrame([(1, 0)], "n long, d long").select(
        div_round_half_away("n", "d")).first()[0] is None


def test_pct_change_rounded_exact(spark):
    rnd = random.Random(11)
    rows = [(Decimal(rnd.randint(1, 10**9)) / 100, Decimal(rnd.randint(1, 10**9)) / 100)
            for _ in range(500)]
    rows += [(Decimal("100.05"), Decimal("100.00")), (Decimal("99.995"), Decimal("100.00")),
             (Decimal("1.00"), Decimal("0.00"))]
    df = spark.createDataFrame(rows, "s decimal(14,2), l decimal(14,2)")
    for r in df.select("s", "l", pct_change_rounded("s", "l").alias("p")).collect():
        if r.l == 0:
            assert r.p is None
            continue
        exact = (Decimal(100) * (r.s - r.l) / r.l)
        want = exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r.p == want, (r.s, r.l, r.p, want)
