"""Property tests: operators against brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.operators import dedup
from ledgerloom.operators.skew import hot_keys, salted_join

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["o1", "o2", "o3", None]),
        st.one_of(st.none(), st.sampled_from(["2025-03-01 09:00:00", "2025-03-01 10:00:00", "2025-03-02 08:00:00"])),
        st.integers(min_value=0, max_value=3),
        st.integers(min_value=-5, max_value=5),
    ),
    min_size=1,
    max_size=25,
)
SCHEMA = "order_id string, created_at string, item_pos int, price int"


def _brute_keep_first(rows):
    def key(r):
        # created_at, item_pos, price ascending, nulls last
        return tuple((v is None, v if v is not None else 0 if isinstance(v, int) else "") for v in (r[1], r[2], r[3]))

    best = {}
    for r in rows:
        if r[0] not in best or key(r) < key(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=lambda r: (r[0] is None, r[0] or ""))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, parts=st.sampled_from(["1", "3", "16"]))
def test_keep_first_matches_brute_force(spark, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = dedup.keep_first(spark.createDataFrame(rows, SCHEMA), "order_id", ("created_at", "item_pos")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = sorted((tuple(r) for r in out), key=lambda r: (r[0] is None, r[0] or ""))
    assert got == _brute_keep_first(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    facts=st.lists(st.tuples(st.integers(0, 200), st.sampled_from(["a", "b", "c", "d"])), min_size=1, max_size=60),
    min_rows=st.integers(1, 20),
    salt_rows=st.integers(1, 10),
)
def test_salted_join_equals_plain_join(spark, facts, min_rows, salt_rows):
    f = spark.createDataFrame([(f"x{i}", k) for i, (_, k) in enumerate(facts)], "id string, k string")
    d = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")  # 'd' has no partner
    hot = hot_keys(f, "k", min_rows, salt_rows)
    for how in ("inner", "left"):
        plain = sorted(tuple(r) for r in f.join(d, "k", how).select("id", "k", "v").collect())
        salted = sorted(tuple(r) for r in salted_join(f, d, "k", hot, salt_by=["id"], how=how).select("id", "k", "v").collect())
        assert salted == plain


def _py_active(v):
    """Plain-Python statement of the boolean rule (trim, lower, token lists,
    then an integer literal: non-zero is true; anything else false)."""
    if v is None:
        return False
    s = v.strip(" \t\n\x0b\x0c\r").lower()
    if s in {"1", "true", "yes", "y", "t"}:
        return True
    if s in {"0", "false", "no", "n", "f"}:
        return False
    body = s[1:] if s[:1] in "+-" else s
    if body and body.isascii() and body.isdigit():
        return int(s) != 0
    return False


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(
        st.one_of(
            st.none(),
            st.sampled_from(["1", " TRUE", "yes ", "Y", "t", "0", "False", "no", "N", "f", "2", "-0", "+7", "1.0", "maybe", "", " "]),
            st.from_regex(r"\A[ ]?[+-]?[0-9]{1,25}[ ]?\Z"),
            st.text(alphabet="tTfFyYnN01 +-.x", max_size=6),
        ),
        min_size=1,
        max_size=30,
    )
)
def test_active_flag_matches_python_rule(spark, values):
    from ledgerloom.functions import active_flag

    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(active_flag("v")).collect()]
    assert got == [_py_active(v) for v in values]
