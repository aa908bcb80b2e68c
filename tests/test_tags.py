"""Tag loaders on hand-made change feeds: one case per rule and quirk."""

from helpers import FIRST_SCHEMA, HISTORY_SCHEMA, TAG_SCHEMA, by_key, d, rows

from tidemark.operators import merge, tags
from tidemark.plans.incremental import chain, step

LOW, HIGH = d("1900-01-01"), d("2030-01-01")
NOW1, NOW2 = d("2024-01-01"), d("2024-01-02")
KEYS = ("k",)


def feed(spark, data):
    return spark.createDataFrame([(k, d(c), d(l), a) for k, c, l, a in data], TAG_SCHEMA)


def test_first_keeps_lowest_version_and_never_changes(spark):
    src = feed(spark, [
        (1, "2020-02-01", "2021-01-01", "U"),
        (1, "2020-01-01", "2021-01-02", "I"),
        (2, "2020-01-01", "2021-01-03", "I"),
    ])
    empty = spark.createDataFrame([], FIRST_SCHEMA)
    ch = tags.first_changes(src, empty, KEYS, LOW, HIGH, NOW1)
    assert rows(ch, "k", "CaptureTimestamp", "Upsert") == [(1, d("2020-01-01"), "I"), (2, d("2020-01-01"), "I")]
    state = merge.apply_first(empty, ch, KEYS)
    # a later, lower capture for a known key is ignored
    later = feed(spark, [(1, "2019-01-01", "2022-01-01", "I")])
    assert tags.first_changes(later, state, KEYS, LOW, HIGH, NOW2).count() == 0


def test_first_tie_goes_to_lowest_action(spark):
    # Q7: with ascending order the lowest code wins a full tie
    src = feed(spark, [(1, "2020-01-01", "2021-01-01", "I"), (1, "2020-01-01", "2021-01-01", "D")])
    empty = spark.createDataFrame([], FIRST_SCHEMA)
    ch = tags.first_changes(src, empty, KEYS, LOW, HIGH, NOW1)
    assert rows(ch, "LakeActionCode") == [("D",)]


def test_latest_newest_wins_late_row_dropped_equal_capture_replaces(spark):
    stored = spark.createDataFrame(
        [(1, d("2020-02-01"), d("2021-01-01"), "I", NOW1), (2, d("2020-02-01"), d("2021-01-01"), "I", NOW1)],
        FIRST_SCHEMA,
    )
    src = feed(spark, [
        (1, "2020-01-01", "2021-06-01", "U"),  # older capture: late row, dropped
        (2, "2020-02-01", "2021-06-01", "D"),  # equal capture: replaces
        (3, "2020-03-01", "2021-06-01", "I"),  # new key
        (3, "2020-03-01", "2021-06-02", "U"),  # newer lake wins for key 3
    ])
    ch = by_key(tags.latest_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2))
    assert set(ch) == {2, 3}
    assert ch[2]["Upsert"] == "U" and ch[2]["LakeActionCode"] == "D"
    assert ch[3]["Upsert"] == "I" and ch[3]["LakeTimestamp"] == d("2021-06-02")
    state = by_key(merge.apply_latest(stored, tags.latest_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2), KEYS))
    assert state[1]["UpdateTimestamp"] == NOW1 and state[2]["UpdateTimestamp"] == NOW2 and len(state) == 3


def test_latest_drops_capture_before_1900_and_ties_take_highest_action(spark):
    # Q14 and the action tie-break
    src = feed(spark, [
        (1, "1899-12-01", "2021-01-01", "I"),
        (2, "2020-01-01", "2021-01-01", "D"),
        (2, "2020-01-01", "2021-01-01", "I"),
    ])
    empty = spark.createDataFrame([], FIRST_SCHEMA)
    ch = tags.latest_changes(src, empty, KEYS, LOW, HIGH, NOW1)
    assert rows(ch, "k", "LakeActionCode") == [(2, "I")]


def test_latest_stored_null_action_is_still_an_update(spark):
    # Q4 fixed: a match marker, not a NULL column, decides insert vs update
    stored = spark.createDataFrame([(1, d("2020-01-01"), d("2021-01-01"), None, NOW1)], FIRST_SCHEMA)
    src = feed(spark, [(1, "2020-02-01", "2021-02-01", "U")])
    ch = tags.latest_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2)
    assert rows(ch, "Upsert") == [("U",)]
    assert merge.apply_latest(stored, ch, KEYS).count() == 1


def history_state(spark, data):
    return spark.createDataFrame(
        [(k, d(c), d(e), d(lk), a, d(u)) for k, c, e, lk, a, u in data], HISTORY_SCHEMA
    )


def test_history_replaced_version_keeps_old_action(spark):
    # Q1: same key and capture, newer lake: lake changes, the action stays
    stored = history_state(spark, [(1, "2020-01-01", "9999-12-31", "2021-01-01", "I", "2024-01-01")])
    src = feed(spark, [(1, "2020-01-01", "2021-06-01", "D")])
    ch = tags.history_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2)
    r = rows(ch, "CaptureTimestamp", "ExpiryTimestamp", "LakeTimestamp", "LakeActionCode", "UpdateTimestamp", "Upsert")
    assert r == [(d("2020-01-01"), d("9999-12-31"), d("2021-06-01"), "I", NOW2, "U")]
    fixed = tags.history_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2, refresh_action=True)
    assert rows(fixed, "LakeActionCode") == [("D",)]


def test_history_closing_interval_keeps_update_time(spark):
    # Q2: closing an interval changes the expiry only
    stored = history_state(spark, [(1, "2020-01-01", "9999-12-31", "2021-01-01", "I", "2024-01-01")])
    src = feed(spark, [(1, "2020-03-01", "2021-06-01", "U")])
    ch = tags.history_changes(src, stored, KEYS, d("2021-01-01"), HIGH, NOW2)
    state = merge.apply_history(stored, ch, KEYS)
    assert rows(state, "CaptureTimestamp", "ExpiryTimestamp", "UpdateTimestamp") == [
        (d("2020-01-01"), d("2020-03-01"), d("2024-01-01")),
        (d("2020-03-01"), d("9999-12-31"), NOW2),
    ]


def test_history_late_row_splits_interval(spark):
    stored = history_state(spark, [
        (1, "2020-01-01", "2020-06-01", "2021-01-01", "I", "2024-01-01"),
        (1, "2020-06-01", "9999-12-31", "2021-01-02", "U", "2024-01-01"),
    ])
    src = feed(spark, [(1, "2020-03-01", "2021-06-01", "U")])
    ch = tags.history_changes(src, stored, KEYS, d("2021-01-02"), HIGH, NOW2)
    state = merge.apply_history(stored, ch, KEYS)
    assert rows(state, "CaptureTimestamp", "ExpiryTimestamp") == [
        (d("2020-01-01"), d("2020-03-01")),
        (d("2020-03-01"), d("2020-06-01")),
        (d("2020-06-01"), d("9999-12-31")),
    ]


def test_history_drops_zero_length_and_open_end_captures(spark):
    # two lake rows of one capture: only the newer survives; Q6: 9999 is dropped
    src = feed(spark, [
        (1, "2020-01-01", "2021-01-01", "I"),
        (1, "2020-01-01", "2021-01-02", "U"),
        (2, "9999-12-31", "2021-01-01", "I"),
    ])
    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    ch = tags.history_changes(src, empty, KEYS, LOW, HIGH, NOW1)
    assert rows(ch, "k", "LakeTimestamp") == [(1, d("2021-01-02"))]


def test_rerun_of_a_finished_window_changes_nothing(spark):
    src = feed(spark, [(1, "2020-01-01", "2021-01-01", "I"), (1, "2020-02-01", "2021-01-02", "U")])
    for kind in ("first", "latest", "history"):
        empty = tags.empty_target(spark, src, KEYS, kind)
        r1 = step(kind, src, empty, KEYS, HIGH, NOW1)
        r2 = step(kind, src, r1.state, KEYS, HIGH, NOW2)
        # First re-reads from its newest *first* version on, but the anti
        # join finds nothing new; the others' windows are closed.
        assert kind == "first" or (not r2.window.is_open and r2.changes is None)
        assert rows(r2.state) == rows(r1.state)


def test_latest_and_history_do_not_depend_on_batching(spark):
    from tidemark import fixtures as fx

    src = fx.tag_source(spark, "/root/testdata/sf0.001")
    marks = [d("1994-01-01"), d("1995-01-01"), d("1996-01-01"), d("1996-04-01"), d("2003-01-01")]
    nows = [NOW1] * len(marks)
    for kind, cols in (
        ("latest", ["k", "CaptureTimestamp", "LakeTimestamp", "LakeActionCode"]),
        ("history", ["k", "CaptureTimestamp", "ExpiryTimestamp", "LakeTimestamp"]),
    ):
        empty = tags.empty_target(spark, src, KEYS, kind)
        one = chain(kind, src, empty, KEYS, marks[-1:], nows[-1:])[-1].state
        many = chain(kind, src, empty, KEYS, marks, nows)[-1].state
        assert rows(one, *cols) == rows(many, *cols)


def test_hot_keys_split_gives_the_same_history(spark):
    # every key counts as hot: versions are cut into parts and carried over
    from tidemark import fixtures as fx

    src = fx.tag_source(spark, "/root/testdata/sf0.001")
    empty = tags.empty_target(spark, src, KEYS, "history")
    marks, nows = [d("1996-01-01"), d("2003-01-01")], [NOW1, NOW2]
    plain = chain("history", src, empty, KEYS, marks, nows)[-1].state
    split = chain("history", src, empty, KEYS, marks, nows, hot_rows=2)[-1].state
    assert rows(split) == rows(plain)
