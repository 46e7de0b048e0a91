from tests.conftest import by, rows
from tidemark.operators import experiments


def test_published_z_test(make):
    counts = make(
        "ab_variant STRING, users BIGINT, purchasers BIGINT",
        [("control", 9918, 374), ("treatment", 10082, 522)],
    )
    got = by(experiments.z_test(counts), "ab_variant")
    assert got["control"]["conv_pct"] == 3.77 and got["treatment"]["conv_pct"] == 5.18
    assert got["control"]["lift_pp"] is None and got["treatment"]["lift_pp"] == 1.41
    assert got["treatment"]["z_score"] == 4.81
    assert got["treatment"]["significant_005"] == "YES"
    assert got["treatment"]["p_value"] < 0.01


def test_heavy_buyers_count_once(make):
    users = make("user_id BIGINT, ab_variant STRING", [(1, "control"), (2, "treatment")])
    orders = make("user_id BIGINT", [(1,), (1,), (1,)])
    assert rows(experiments.ab_rates(users, orders)) == [(100.0, 0.0, -1.41, 1, 1)]


def test_no_conversions_at_all_has_no_score(make):
    users = make("user_id BIGINT, ab_variant STRING", [(1, "control"), (2, "treatment")])
    got = by(experiments.ab_test(users, make("user_id BIGINT", [])), "ab_variant")
    assert got["treatment"]["z_score"] is None
    assert got["treatment"]["significant_005"] == "no"


def test_segment_conversion(make):
    users = make("user_id BIGINT, channel STRING", [(i, "a" if i < 4 else "b") for i in range(8)])
    buyers = make("user_id BIGINT", [(0,), (1,), (4,)])
    got = rows(experiments.segment_conversion(users, buyers, "channel"))
    assert got == [
        ("a", 4, 2, 50.0, 37.5, 33.3, 2.0),
        ("b", 4, 1, 25.0, 37.5, -33.3, 2.0),
    ]


LOG = "link_used STRING, outcome STRING"


def test_lift_reads_text_flags_and_skips_pending_rows(make):
    log = make(
        LOG,
        [
            (" YES ", "Interview"), ("1", "none"), ("true", " "), ("y", None),
            ("no", "offer"), ("false", "reject"), (None, "none"), ("0", "none"),
        ],
    )
    assert rows(experiments.outcome_lift(log)) == [
        (2, 50.0, 4, 25.0, 25.0, 100.0, "positive", True)
    ]


def test_lift_is_undefined_for_an_empty_arm_or_a_zero_base(make):
    empty = rows(experiments.outcome_lift(make(LOG, [("yes", "offer")])))
    assert empty == [(1, 100.0, 0, None, None, None, "undefined", None)]
    zero = rows(experiments.outcome_lift(make(LOG, [("yes", "offer"), ("no", "none")])))
    assert zero == [(1, 100.0, 1, 0.0, None, None, "undefined", None)]
