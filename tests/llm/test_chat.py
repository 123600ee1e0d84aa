"""Chat formatting: event folding, escaping, read-back."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import chat

EVENTS = "conv_id long, msg long, seq long, kind string, role string, text string"


def test_deltas_edits_regenerations_and_deletions_fold(spark):
    log = [
        (1, 0, 0, "open", "user", None), (1, 0, 2, "delta", None, "lo"), (1, 0, 1, "delta", None, "hel"),
        (1, 1, 0, "open", "assistant", None), (1, 1, 1, "delta", None, "bad"), (1, 1, 2, "regenerate", None, None),
        (1, 1, 3, "delta", None, "go"), (1, 1, 4, "delta", None, "od"),
        (1, 2, 0, "open", "user", None), (1, 2, 1, "delta", None, "x"), (1, 2, 2, "edit", None, "y"), (1, 2, 3, "delta", None, "z"),
        (1, 3, 0, "open", "user", None), (1, 3, 1, "delta", None, "gone"), (1, 3, 2, "delete", None, None),
        (None, 0, 0, "open", None, None), (2, 0, 0, "open", "assistant", None),
    ]
    got = {(r.conv_id, r.msg): (r.role, r.text) for r in chat.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == {(1, 0): ("user", "hello"), (1, 1): ("assistant", "good"), (1, 2): ("user", "yz"), (None, 0): ("", ""),
                   (2, 0): ("assistant", "")}
    assert chat.fold_events(spark.createDataFrame([], EVENTS)).count() == 0


def test_events_of_one_seq_apply_in_the_order_of_kind_and_text(spark):
    log = [
        (1, 0, 0, "open", "user", None), (1, 0, 1, "delta", None, "same "), (1, 0, 1, "edit", None, "NEW"),            # the edit comes after the delta
        (2, 0, 0, "open", "user", None), (2, 0, 1, "delta", None, "old"), (2, 0, 1, "regenerate", None, None), (2, 0, 2, "delta", None, "new"),
        (3, 0, 0, "open", "user", None), (3, 0, 1, "edit", None, "b"), (3, 0, 1, "edit", None, "a"), (3, 0, 1, "edit", None, "b"), (3, 0, 2, "delta", None, "!"),
        (4, 0, 0, "open", "user", None), (4, 0, 1, "edit", None, "back"), (4, 0, 1, "delete", None, None),             # the deletion comes first
        (5, 0, 0, "open", "user", None), (5, 0, 1, "delta", None, "x"), (5, 0, 1, "delta", None, "x"),                 # repeated events count each time
    ]
    got = {r.conv_id: r.text for r in chat.fold_events(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == {1: "NEW", 2: "new", 3: "b!", 4: "back", 5: "xx"}


def test_log_of_rows_has_drafts_that_are_replaced(spark):
    rows = [(1, t, "user", f"text {t}") for t in range(6)] + [(1, None, None, None)]
    log = chat.events_of_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.collect()} == {"open", "delta", "edit", "regenerate"}
    assert sorted((r.role, r.text) for r in chat.fold_events(log).collect()) == sorted((r or "", t or "") for *_, r, t in rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="\\012<|>s/[]INST turnexd\n", max_size=40), min_size=1, max_size=30))
def test_escaping_is_reversible_and_leaves_no_control_string(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_query_reads_back_every_turn(spark, tables):
    rows = [(1, 0, "user", None, 9), (1, 2, "assistant", "b<|end|>\n", 9), (1, 1, None, "a\\1", 9), (1, 2, "assistant", "", 9),
            (2, None, "assistant", "x", 9), (None, 0, "user", "n", 9), (3, 0, "assistant", "y" * 50000, 9)]
    d = tables(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int"))
    got = {r.conv_id: r for r in chat.op3_chat_format(spark, d).collect()}

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert set(got) == {1, 2, 3, None, -1}
    assert got[1].n_turns == 4
    assert got[1].turns_sha256 == sha("user\n\n" + "\na\\1\n" + "assistant\n\n" + "assistant\nb<|end|>\n\n")
    assert got[1].loss_sha256 == sha("b<|end|>\n") and got[1].loss_chars == 9
    assert got[3].loss_chars == 50000
    assert got[-1].turns_sha256 == sha(f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n")
    assert got[-1].loss_sha256 == sha(chat.PROBE)


def test_no_python_runs_in_the_plan(spark):
    df = chat.op3_chat_format(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
