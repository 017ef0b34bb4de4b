import json

from pyspark.sql import functions as F

from episodica.functions import replies as R

FULL = {"observed_final_state": "on the table", "goal_predicate": "in the box", "predicate_holds": "No", "score": 0.3}


def reply(content="", finish="stop", tokens=(0, 0), **more):
    return json.dumps({"role": "assistant", "content": content, **more}), finish, *tokens


CASES = [
    (reply("so " + json.dumps(FULL)), 0.5, "no", "score snapped 0.3 -> 0.5", ""),
    (reply(json.dumps(FULL | {"score": "1", "predicate_holds": "yes "})), 1.0, "yes", "", ""),
    (reply(json.dumps(FULL | {"score": None, "predicate_holds": "yes"})), 1.0, "yes", "score corrected None -> 1.0 (predicate_holds=yes)", ""),
    (reply(json.dumps(FULL | {"score": "high"})), 0.0, "no", "score missing, defaulted to 0.0 (predicate_holds=no)", ""),
    (reply(json.dumps(FULL | {"score": 1})), 0.5, "no", "score corrected 1 -> 0.5 (predicate_holds=no)", ""),
    (reply(json.dumps(FULL | {"score": 0.1})), 0.0, "no", "score snapped 0.1 -> 0.0", ""),
    (reply(json.dumps(FULL | {"predicate_holds": "maybe"})), 0.3, "maybe", "predicate_holds unreadable: 'maybe'", ""),
    (reply(json.dumps(FULL | {"score": 0})[:-1] + ",}"), 0.0, "no", "model emitted malformed JSON; repaired client-side", ""),
    (reply("", thinking=json.dumps(FULL | {"score": 0.5}), finish="length"), 0.5, "no", R.TRUNCATED, ""),
    (reply('{"goal_predicate": "x"}'), None, None, "", "model stopped early — JSON is missing predicate_holds, score. Try --structured, which forces every key."),
    (reply("nothing", "length", (90, 7)), None, None, R.TRUNCATED, "no JSON object in model output — generation stopped at max_tokens=10000 before the JSON was written; 90 prompt tokens consumed by the video (+7 generated)"),
    (reply("", reasoning="hm"), None, None, "", "no JSON object in model output — the model never closed its reasoning block"),
    (reply(""), None, None, "", "no JSON object in model output — content and reasoning are both empty; non-empty message keys: role"),
    (reply("plain"), None, None, "", "no JSON object in model output"),
]


def test_judged(spark, tmp_path):
    rows = [(str(i), "t", *c[0]) for i, c in enumerate(CASES)]
    d = R.judged(spark.createDataFrame(rows, "video string, task string, message string, finish_reason string, prompt_tokens int, completion_tokens int"))
    got = {int(r.video): (r.score, r.predicate_holds, r.note, r.error) for r in d.collect()}
    for i, c in enumerate(CASES):
        assert got[i] == c[1:], i
    one = R.tally(d).first()
    assert (one.n, one.n_scored, one.n_full, one.n_half, one.n_none, one.n_changed, one.n_errors) == (14, 9, 2, 3, 3, 4, 5)
    R.write_results(d, f"{tmp_path}/lines", csv=f"{tmp_path}/flat")
    lines = spark.read.json(f"{tmp_path}/lines")
    assert lines.count() == 14 and "raw" not in lines.columns and "note" in lines.columns
    flat = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/flat")
    assert flat.columns == list(R.RESULT_COLUMNS) and flat.count() == 14
    R.append_verdicts(lines.limit(2), f"{tmp_path}/log")
    R.append_verdicts(lines.limit(3), f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 5


def test_message_text(spark):
    messages = ['{"content": "a", "reasoning": "", "thinking": "b"}', '{"content": null, "reasoning_content": "c", "reasoning": "d"}', "{}", None]
    content, reasoning = R.message_text(F.col("m"))
    got = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "i int, m string").orderBy("i").select(content.alias("c"), reasoning.alias("r")).collect()
    assert [tuple(r) for r in got] == [("a", "b"), ("", "c"), ("", ""), ("", "")]


def test_evaluate_with_a_client(spark):
    from episodica.sources import judge

    def client(video, task, way):
        if video == "gone":
            raise OSError("file not found: gone")
        if way != "guided_json":
            raise RuntimeError("Error code: 400 - unknown field")
        return {"message": {"content": json.dumps({**FULL, "score": 0.5, "goal_predicate": task})}, "finish_reason": "stop", "prompt_tokens": 3}

    jobs = spark.createDataFrame([("a", "fold"), ("gone", "fold"), ("b", "lift")], "video string, task string").coalesce(1)
    got = {r.video: (r.score, r.goal_predicate, r.error) for r in judge.evaluate(jobs, client, judge.WAYS).collect()}
    assert got == {"a": (0.5, "fold", ""), "b": (0.5, "lift", ""), "gone": (None, None, "OSError: file not found: gone")}
    last = judge.evaluate(jobs.where("video = 'a'"), client, judge.WAYS[:2]).first()
    assert last.score is None and last.error == "RuntimeError: Error code: 400 - unknown field"
    assert [judge.sampling_step(n, m) for n, m in ((100, 0), (10, 20), (100, 30), (100, 99))] == [1, 1, 3, 1]
