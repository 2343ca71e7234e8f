"""Operators against brute-force Python models on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlake.operators import dimensions, unify

SETTINGS = dict(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-2, 2)),
              st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
    min_size=1, max_size=25)


def _model_pick(rows, largest):
    """First row per key under ORDER BY v, s (both DESC or both ASC), NULLS LAST."""
    if largest:
        def better(a, b):  # DESC NULLS LAST: a non-NULL beats NULL, then the larger value
            return ((a[0] is not None, a[0] or 0), (a[1] is not None, a[1] or "")) > \
                   ((b[0] is not None, b[0] or 0), (b[1] is not None, b[1] or ""))
    else:
        def better(a, b):  # ASC NULLS LAST: a non-NULL beats NULL, then the smaller value
            return ((a[0] is None, a[0] or 0), (a[1] is None, a[1] or "")) < \
                   ((b[0] is None, b[0] or 0), (b[1] is None, b[1] or ""))
    best = {}
    for k, v, s in rows:
        if k not in best or better((v, s), best[k]):
            best[k] = (v, s)
    return sorted((k, v, s) for k, (v, s) in best.items())


@settings(**SETTINGS)
@given(rows=rows_strategy, largest=st.booleans())
def test_pick_one_matches_model(spark, rows, largest):
    df = spark.createDataFrame(rows, "k int, v int, s string")
    got = sorted(tuple(r) for r in unify.pick_one(df, ["k"], ["v"], largest=largest).collect())
    assert got == _model_pick(rows, largest)


@settings(**SETTINGS)
@given(keys=st.sets(st.integers(-1000, 1000), min_size=1, max_size=60),
       parts=st.one_of(st.none(), st.integers(1, 6)), start=st.integers(0, 50))
def test_assign_keys_matches_model(spark, keys, parts, start):
    df = spark.createDataFrame([(k,) for k in keys], "nk int")
    got = sorted((r.nk, r.sk) for r in dimensions.assign_keys(df, ["nk"], "sk", start, parts).collect())
    assert got == [(k, start + i + 1) for i, k in enumerate(sorted(keys))]


@settings(**SETTINGS)
@given(current=st.dictionaries(st.integers(0, 15), st.one_of(st.none(), st.sampled_from(["x", "y"])), max_size=10),
       incoming=st.lists(st.tuples(st.integers(0, 15), st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))),
                         max_size=15))
def test_scd1_upsert_matches_merge_model(spark, current, incoming):
    cur_rows = [(i + 1, k, "S", a) for i, (k, a) in enumerate(sorted(current.items()))]
    cur = spark.createDataFrame(cur_rows, "key bigint, nk int, src string, attr string") if cur_rows else None
    inc = spark.createDataFrame([(k, "S", a) for k, a in incoming] or [(0, "S", None)][:0],
                                "nk int, src string, attr string")
    got = sorted(tuple(r) for r in dimensions.scd1_upsert(cur, inc, "key", ["nk", "src"], "attr")
                 .select("key", "nk", "src", "attr").collect())
    # model: per incoming key take the least attr (NULLS LAST); update matched, append new keys in order
    src = {}
    for k, a in incoming:
        if k not in src or ((a is None), a or "") < ((src[k] is None), src[k] or ""):
            src[k] = a
    model = {k: (i + 1, a) for i, (k, a) in enumerate(sorted(current.items()))}
    for k in model:
        if k in src:
            model[k] = (model[k][0], src[k])
    top = len(current)
    for j, k in enumerate(sorted(set(src) - set(current))):
        model[k] = (top + j + 1, src[k])
    assert got == sorted((key, k, "S", a) for k, (key, a) in model.items())


def _murmur(data: bytes, seed: int = 42) -> int:
    """32-bit Murmur3 of whole words of four bytes and then single bytes, as a signed number's absolute value."""
    mask = 0xFFFFFFFF

    def turned(x, n):
        return (x << n | x >> 32 - n) & mask

    h, whole = seed, len(data) // 4 * 4
    words = [int.from_bytes(data[k:k + 4], "little") for k in range(0, whole, 4)]
    words += [b - 256 if b > 127 else b for b in data[whole:]]
    for w in words:
        h = (turned(h ^ turned(w * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask, 13) * 5 + 0xE6546B64) & mask
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & mask
    return abs(h - (1 << 32) if h >> 31 else h)


def test_murmur_identity_matches_a_plain_version(spark):
    from martlake.functions import scalars as S
    texts = ["", "a", "ab", "abc", "abcd", "abcde", "user123@example.com", "é@ü.org", "日本"] + [f"shopper{k}@mail.net" for k in range(200)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.identity_murmur("t").alias("h")).collect()
    assert {r.t: r.h for r in got} == {t: _murmur(t.encode()) for t in texts}
