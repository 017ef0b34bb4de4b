"""From a judge's raw reply to a verdict row: its text, its object, the score rule and what to tell the user."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import verdicts as V
from .numbers import fixed

#: Where a reply may keep its reasoning, the keys it must have, the columns of a result file, and the notes that users read.
REASONING = ("reasoning_content", "reasoning", "thinking")
REQUIRED = ("goal_predicate", "predicate_holds", "score")
RESULT_COLUMNS = ("video", "task", "score", "predicate_holds", "goal_predicate", "observed_final_state", "note", "error")
TRUNCATED = "output truncated at max_tokens; raise --max-tokens"
NO_OBJECT = "no JSON object in model output"
CUT_OFF = "generation stopped at max_tokens=%d before the JSON was written"
OPEN_REASONING = "the model never closed its reasoning block"
EMPTY = "content and reasoning are both empty; non-empty message keys: "
TOKENS = "%d prompt tokens consumed by the video (+%d generated)"
STOPPED = "model stopped early — JSON is missing %s. Try --structured, which forces every key."


def message_text(message: Column) -> tuple[Column, Column]:
    """Content and reasoning of a message given as JSON; empty strings where it has none."""
    at = lambda k: F.nullif(F.get_json_object(message, f"$.{k}"), F.lit(""))
    return F.coalesce(at("content"), F.lit("")), F.coalesce(*map(at, REASONING), F.lit(""))


def found(c: Column) -> Column:
    """The last object of a text as (object, repaired, score, holds); the latter two as notes show them. NULL without one."""

    def one(text: str | None) -> tuple | None:
        for blob in V._objects(text or ""):
            got = V._loads(blob)
            if got is not None:
                return json.dumps(got), V._object(blob) is None, repr(got.get("score")), repr(got.get("predicate_holds"))
        return None

    def run(s: pd.Series) -> pd.DataFrame:
        rows = [one(t) or (None, None, None, None) for t in s]
        return pd.DataFrame(rows, columns=["object", "repaired", "score", "holds"])

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    got = F.pandas_udf(run, "object string, repaired boolean, score string, holds string")(c)
    return F.when(got["object"].isNotNull(), got)


def reconcile_note(holds: Column, raw: Column, shown: Column | None = None, shown_holds: Column | None = None) -> Column:
    """What was done to a score, in words; empty where it was taken as it is.

    shown and shown_holds: the values as a note prints them, by default numbers bare, other texts quoted.
    """
    quoted = lambda c: F.when(c.isNull(), "None").when(c.try_cast("double").isNotNull(), c).otherwise(F.concat(F.lit("'"), c, F.lit("'")))
    shown = quoted(raw) if shown is None else shown
    shown_holds = quoted(holds) if shown_holds is None else shown_holds
    kind = V.reconcile(holds, raw)[1]
    value = V.reconcile(holds, raw)[0]
    yes = F.lower(F.trim(F.coalesce(holds, F.lit("")))) == "yes"
    says = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return (
        F.when(kind == "", "")
        .when(yes, says("score corrected ", shown, " -> 1.0 (predicate_holds=yes)"))
        .when(kind == "missing", "score missing, defaulted to 0.0 (predicate_holds=no)")
        .when(kind == "corrected", says("score corrected ", shown, " -> 0.5 (predicate_holds=no)"))
        .when(kind == "snapped", says("score snapped ", shown, " -> ", fixed(value, 1)))
        .otherwise(says("predicate_holds unreadable: ", shown_holds))
    )


def _joined(*parts: Column) -> Column:
    return F.concat_ws("; ", *[F.nullif(p, F.lit("")) for p in parts])


def _present_keys(message: Column) -> Column:
    """Keys of a message whose value is neither null, zero, false nor empty."""
    blank = ("", "[]", "{}", "0", "0.0", "false")
    keys = F.map_keys(F.map_filter(F.from_json(message, "map<string,string>"), lambda _, v: v.isNotNull() & ~v.isin(*blank)))
    return F.coalesce(F.nullif(F.array_join(keys, ", "), F.lit("")), F.lit("none"))


def judged(replies: DataFrame, max_tokens: int = 10000) -> DataFrame:
    """Replaces message, finish_reason, prompt_tokens and completion_tokens by a verdict.

    Adds raw, reasoning, observed_final_state, goal_predicate, predicate_holds, score, note
    and error. The object is looked for in the content, then in the reasoning. A reply
    without one, or without a required key, has an error and no score.
    """
    raw, reasoning = message_text(F.col("message"))
    d = replies.withColumns({"raw": raw, "reasoning": reasoning})
    d = d.withColumn("__p", F.coalesce(found(F.col("raw")), found(F.col("reasoning"))))
    obj, cut = F.col("__p.object"), F.coalesce(F.col("finish_reason") == "length", F.lit(False))
    field = lambda k: F.get_json_object(obj, f"$.{k}")
    none, silent = obj.isNull(), (F.col("raw") == "") & (F.col("reasoning") == "")
    missing = F.array_compact(F.array(*[F.when(~F.array_contains(F.json_object_keys(obj), k), F.lit(k)) for k in REQUIRED]))
    short = ~none & (F.size(missing) > 0)
    hints = _joined(
        F.when(cut, CUT_OFF % max_tokens), F.when((F.col("raw") == "") & (F.col("reasoning") != ""), OPEN_REASONING), F.when(silent, F.concat(F.lit(EMPTY), _present_keys(F.col("message")))),
        F.when(F.col("prompt_tokens") > 0, F.format_string(TOKENS, F.col("prompt_tokens"), F.coalesce("completion_tokens", F.lit(0)))),
    )
    error = F.when(none, F.concat_ws(" — ", F.lit(NO_OBJECT), F.nullif(hints, F.lit("")))).when(short, F.format_string(STOPPED, F.array_join(missing, ", "))).otherwise("")
    whole = ~none & ~short
    value = V.reconcile(field("predicate_holds"), field("score"))[0]
    said = reconcile_note(field("predicate_holds"), field("score"), F.col("__p.score"), F.col("__p.holds"))
    note = _joined(F.when(cut, TRUNCATED), F.when(whole & F.col("__p.repaired"), V.REPAIRED), F.when(whole, said))
    out = {
        "observed_final_state": field("observed_final_state"), "goal_predicate": F.when(whole, field("goal_predicate")),
        "predicate_holds": F.when(whole, F.nullif(F.lower(F.trim(field("predicate_holds"))), F.lit(""))), "score": F.when(whole, value), "note": note, "error": error,
    }
    return d.withColumns(out).drop("__p", "message", "finish_reason", "prompt_tokens", "completion_tokens")


def tally(results: DataFrame) -> DataFrame:
    """One row: results, those with a score, its mean, counts of 1, 0.5 and 0, scores that were changed, and errors."""
    ok = (F.coalesce("error", F.lit("")) == "") & F.col("score").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    changed = F.col("note").contains("corrected") | F.col("note").contains("snapped")
    score = F.when(ok, F.col("score"))
    return results.agg(F.count("*").alias("n"), n(ok).alias("n_scored"), F.avg(score).alias("mean"), n(score == 1).alias("n_full"), n(score == 0.5).alias("n_half"), n(score == 0).alias("n_none"), n(ok & changed).alias("n_changed"), n(~ok).alias("n_errors"))


def write_results(results: DataFrame, path: str, csv: str | None = None, keep_reasoning: bool = False) -> None:
    """JSON lines, without the long texts unless asked for, and a flat table of fixed columns."""
    lines = results if keep_reasoning else results.drop("raw", "reasoning")
    lines.write.option("ignoreNullFields", False).json(path)
    if csv:
        have = set(results.columns)
        results.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in RESULT_COLUMNS]).write.option("header", True).option("escape", '"').csv(csv)


def append_verdicts(verdicts: DataFrame, path: str, order: str | None = None) -> int:
    """One more commit to a log that ``sources.datasets.read_verdicts`` reads; its number.

    ``order``: a column that gives the order of lines; without it lines follow the
    partitions. Lines carry the commit's number and their place in it. They are
    staged beside the log and renamed into it as a whole, so that a commit that
    fails leaves nothing, and one whose number has been taken in the meantime takes
    the next. ``compact_verdicts`` merges commits.
    """
    from ..sources.datasets import commit_verdicts

    line = F.row_number().over(W.orderBy(order)) if order else F.monotonically_increasing_id()
    return commit_verdicts(verdicts.withColumn("line", line.cast("long")), path)
