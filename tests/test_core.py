"""Core operators: nested records, deliveries, sampling, chats, training arithmetic, text, events, rollouts, files."""

import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import grading, text
from millrace.operators import chat, events, nested, retrieval, rollout, sampling, training
from millrace.operators.deliveries import latest_delivery
from millrace.sources import files
from millrace.streaming import jobs

MESSAGE = "struct<role:string,content:string,reasoning:string,name:string,tool_call_id:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>>"


def rows(df):
    return set(map(tuple, df.collect()))


def msg(role, content=None, answers=None, calls=None):
    return (role, content, None, None, answers, None if calls is None else [(i, "function", (n, "{}")) for i, n in calls])


# --- nested -----------------------------------------------------------------------------------------------------------


def brute_links(rec, messages, tools):
    """Another way to the same links: every call looks for its answer."""
    out = set()
    entries = nested.declared(tools)
    names = [nested.tool_of(e)[0] for e in entries]

    def walk(parent, schema):
        if isinstance(schema, list):
            for x in schema:
                walk(parent, x)
        if isinstance(schema, dict):
            for name, p in (schema.get("properties") or {}).items() if isinstance(schema.get("properties"), dict) else ():
                out.add((rec, "param", parent, f"{parent}.{name}"))
                walk(f"{parent}.{name}", p)
            if "items" in schema:
                walk(parent, schema["items"])

    for k, e in enumerate(entries):
        walk(f"t{k}", nested.tool_of(e)[2])
    order = []
    for i, m in enumerate(messages or ()):
        if m is None:
            continue
        if m[0] == "tool":
            order.append(("answer", m[4], f"m{i}", i))
        for j, c in enumerate(m[5] or ()):
            order.append(("call", c[0], f"m{i}.c{j}", i))
            out.add((rec, "call", f"m{i}", f"m{i}.c{j}"))
            if c[2][0] in names and c[2][0] is not None:
                out.add((rec, "use", f"t{names.index(c[2][0])}", f"m{i}.c{j}"))
    for at, (kind, call, key, i) in enumerate(order):
        if kind == "call" and call is not None:
            after = next((o for o in order[at + 1 :] if o[1] == call), None)
            if after and after[0] == "answer" and after[3] > i:
                out.add((rec, "answer", key, after[2]))
    return out


TOOLS = [
    None, "", "not json", "[1, null, \"bare\", \"{\\\"name\\\": \\\"enc\\\"}\"]", json.dumps(json.dumps([{"name": "a", "parameters": {"properties": {"x": {"properties": {"y": {}}}}}}])),
    json.dumps({"tools": [{"type": "function", "function": {"name": "b", "parameters": {"properties": {"l": {"type": "array", "items": {"items": {"properties": {"deep": {}}}}}}}}}]}),
    json.dumps([{"name": "a", "input_schema": {"properties": {"p": True, "q.r": {}}}}, "a"]), "{\"tools\": 3}", "[",
]


def test_links_match_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i in range(120):
        messages = []
        for _ in range(rng.randrange(0, 8)):
            pick = lambda: rng.choice([None, "x", "y", "z"])
            messages.append(rng.choice([None, msg("user", "hi"), msg("tool", "ok", pick()), msg("assistant", None, None, [(pick(), rng.choice(["a", "b", "bare", "enc", None])) for _ in range(rng.randrange(0, 3))])]))
        data.append((i, rng.choice([messages, messages, None]), rng.choice(TOOLS)))
    df = spark.createDataFrame(data, f"run bigint, m array<{MESSAGE}>, t string").withColumn("tag", F.lit(1))
    want = set().union(*(brute_links(*r) for r in data))
    for payload in (False, True):
        assert rows(nested.links(nested.emit(df, "run", "m", "t", payload)).select("rec_id", "link", "parent_key", "child_key")) == want
    assert nested.emit(df.limit(0), "run", "m", "t").count() == 0


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [msg("user", "hé"), msg("assistant", None, None, [("i", "f")]), msg("tool", "x" * 100_000, "i")], TOOLS[4])], f"r bigint, m array<{MESSAGE}>, t string")
    nested.write_tables(nested.emit(df, "r", "m", "t"), f"{tmp_path}/t")
    read = lambda tag: nested.read_table(spark, f"{tmp_path}/t", tag)
    assert [r.content and len(r.content) for r in read("messages").orderBy("pk").collect()] == [2, None, 100_000]
    assert rows(read("answers").select("parent_key", "pk", "id")) == {("m1.c0", "m2", "i")}
    assert rows(read("params").select("parent_key", "pk", "name")) == {("t0", "t0.x", "x"), ("t0.x", "t0.x.y", "y")}


def test_deep_schemas_have_no_limit():
    schema = {}
    for _ in range(5000):
        schema = {"properties": {"a": schema}}
    assert sum(1 for _ in nested.parameters("t0", schema)) == 5000


# --- deliveries, sampling ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bound", [1000, 0])
def test_latest_delivery(spark, tmp_path, bound):
    data = [(1, 10, "a"), (1, 12, "b"), (1, 11, "c"), (2, None, "d"), (2, 5, "e"), (3, 7, "f"), (3, 7, "f"), (None, 1, "g")]
    df = spark.createDataFrame(data, "k bigint, ingested_at bigint, v string")
    df.write.parquet(f"{tmp_path}/x")
    for x in (df, spark.read.parquet(f"{tmp_path}/x")):
        assert sorted(r.v for r in latest_delivery(x, "k", broadcast_ids=bound).collect()) == ["b", "e", "f"]
        assert latest_delivery(x.limit(0), "k").count() == 0


def test_sampling(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert [r.id for r in sampling.sliced(df, "id", 10, 13).collect()] == [10, 11, 12]
    assert {(r.id, r.batch) for r in sampling.batches(df, "id", 30, True).collect()} == {(i, i // 30) for i in range(90)}
    chunks = {r.id: r.chunk for r in sampling.even_chunks(df.where("id < 5"), "id", 3).collect()}
    assert chunks == {0: 0, 1: 1, 2: 1, 3: 2, 4: 2}  # edges floor(i n / k): 0, 1, 3, 5
    assert sampling.stratified(df, "g", "id", 4).groupBy("g").count().select("count").distinct().collect()[0][0] == 4
    assert sampling.split(df, "id", 100).where("part = 'test'").count() == 0 and sampling.split(df, "id", 7).where("part = 'test'").count() == 7
    assert sorted(r.idx for r in sampling.representatives(df, "id", "id", 4).collect()) == [0, 33, 66, 99]
    assert sampling.replicated(df, 0).count() == 0 and sampling.sample(df, "id", 5).count() == 5


# --- chats ------------------------------------------------------------------------------------------------------------


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("x")).collect()


def test_tool_filters_and_caps(spark):
    ok, bad, err = [msg("assistant", "", None, [("i", "f")]), msg("tool", '{"error": ""}', "i")], [msg("assistant", "", None, [("i", "f")]), msg("tool", "Error 403", "i")], [msg("assistant", "", None, [("i", "f")]), msg("tool", '{"error": "no"}', "i")]
    assert [r.x for r in one(spark, chat.sound_tool_use(F.col("m")), [(ok,), (bad,), (err,), ([],)], f"m array<{MESSAGE}>")] == [True, False, False, False]
    long = [msg("tool", "x" * n) for n in (50_000, 30_000, 45_000)]
    got = one(spark, F.transform(chat.capped(F.col("m")), lambda m: F.length(m["content"])), [(long,)], f"m array<{MESSAGE}>")
    assert got[0].x == [50_000, 30_000, 40_000]


def test_code_blocks(spark):
    data = [("a ```Python\nx = 1\n  ``` b",), ("```python\nx",), ("none",), (None,), ("```python\n```",), ("```python a``` ```PYTHON b```",)]
    assert [r.x for r in one(spark, chat.code_block(F.col("t")), data, "t string")] == ["x = 1", None, None, None, "", " b"]


# --- training ---------------------------------------------------------------------------------------------------------


def test_unit_vectors(spark):
    get = lambda e: spark.range(1).select(e.alias("x")).collect()[0].x
    assert get(training.discounted(F.array(*[F.lit(float(x)) for x in (1, 2, 4)]), 0.5)) == [3.0, 4.0, 4.0]
    assert get(training.discounted(F.array().cast("array<double>"), 0.5)) == []
    x, y = training.shifted(F.array(*map(F.lit, (5, 6, 7))))
    assert (get(x), get(y)) == ([5, 6], [6, 7])
    x, y = training.shifted(F.array(*map(F.lit, (5, 6, 7))), 2)
    assert (get(x), get(y)) == ([5], [6])
    pairs = training.matchups(spark.range(6).withColumn("g", F.lit(1)), "g", "id", "id", 3, False)
    assert rows(pairs.select("a", "b")) == {(0, 1), (0, 2), (1, 2), (3, 4), (3, 5), (4, 5)}
    adv = training.centred(spark.createDataFrame([(1, float(r)) for r in (1, 0, 0, 1)], "g int, r double"), "g", "r")
    assert sorted(r.advantage for r in adv.collect()) == [-0.5, -0.5, 0.5, 0.5]
    groups = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 0.0), (2, 1.0)], "g int, r double")
    assert {r.g for r in training.varied_groups(groups, "g", "r").collect()} == {2}
    assert {r.g for r in training.varied_groups(groups.where("g = 1"), "g", "r").collect()} == {1}
    stopped = training.stopped(spark.createDataFrame([(i, 5) for i in range(4)], "s int, t int"), "s", "t", 10)
    assert stopped.count() == 2


def test_segments(spark):
    turns = [(1, 0, [1], [1, 2]), (1, 1, [1, 2, 3], [1, 2, 3, 4]), (1, 2, [9], [9, 8])]
    got = training.segments(spark.createDataFrame(turns, "k int, t int, seen array<int>, full array<int>"), "k", "t", "seen", "full")
    assert [r.segment for r in got.orderBy("t").collect()] == [1, 1, 2]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=4), min_size=1, max_size=8), st.integers(1, 5))
def test_alignment_matches_two_pointers(spark, pieces, width):
    whole = "".join(pieces)
    other = [whole[i : i + width] for i in range(0, len(whole), width)]
    a = spark.createDataFrame([(1, i, p, -1.0) for i, p in enumerate(pieces)], "k int, pos int, piece string, lp double")
    b = spark.createDataFrame([(1, i, p, -2.0) for i, p in enumerate(other)], "k int, pos int, piece string, lp double")
    want, i, j, x, y, ni, nj = [], 0, 0, "", "", 0, 0
    while i < len(pieces) or j < len(other):
        if len(x) <= len(y) and i < len(pieces):
            x, i, ni = x + pieces[i], i + 1, ni + 1
        else:
            y, j, nj = y + other[j], j + 1, nj + 1
        if x and x == y:
            want.append((ni, nj))
            x, y, ni, nj = "", "", 0, 0
    got = training.aligned(a, b, ["k"], "lp", "lp").orderBy("stop").collect()
    assert [(r.n_left, r.n_right) for r in got] == want


def test_alignment_within_rows_is_that_of_pieces(spark):
    rng = random.Random(9)
    cuttings = [(40, [], [2])]
    for k in range(40):
        n = rng.randrange(1, 60)
        # every third right side is of a shorter text: what follows the last common end is in no group
        ends = [sorted({*rng.sample(range(1, n + 1), min(n, 8))} | last) for last in ({n}, {n} if k % 3 else set())]
        cuttings.append((k, *[[y - x for x, y in zip([0, *e], e)] for e in ends]))
    lp = lambda k, i: -((k * 7 + i * 13) % 100) / 4.0
    sides = [spark.createDataFrame([(c[0], i, "x" * n, lp(c[0] + j, i)) for c in cuttings for i, n in enumerate(c[1 + j])], "k int, pos int, piece string, lp double") for j in range(2)]
    arrays = spark.createDataFrame([(k, x, [lp(k, i) for i in range(len(x))], y, [lp(k + 1, i) for i in range(len(y))]) for k, x, y in cuttings] + [(41, None, None, [1], [-1.0]), (42, [2, 0], [-1.0, -2.0], [0, 2], [-3.0, -4.0])], "k int, nx array<int>, x array<double>, ny array<int>, y array<double>")
    got = rows(training.aligned_within(arrays.repartition(3), ["k"], "nx", "x", "ny", "y"))
    # pieces of no length are in no group
    assert got == rows(training.aligned(*sides, ["k"], "lp", "lp")) | {(42, 2, 1, 1, 3.0)} and len(got) > 60


def test_alignment_shuffles_no_pieces(spark, tmp_path):
    from millrace.plans.training import QUERIES

    said = [("a", "s", [msg("user", "hi"), msg("assistant", "one two\n three ")], 1)]
    spark.createDataFrame(said, f"chat_id string, source string, messages array<{MESSAGE}>, ingested_at int").write.parquet(f"{tmp_path}/chats.parquet")
    df = QUERIES["align_groups_kl"](spark, str(tmp_path))
    assert [(r.conv_id, r.n_groups, r.n_left, r.n_right) for r in df.collect()] == [("a", 1, 3, 5)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Window" not in plan and "SortMergeJoin" not in plan


# --- text -------------------------------------------------------------------------------------------------------------


def test_scalars(spark):
    x = F.col("x")
    cases = [
        (text.normalized_answer(x), "The  Eiffel-Tower!", "eiffeltower"), (text.marked_answer(x), "x Answer: Paris", "Paris"), (text.marked_answer(x), "Answer: a Answer: b", None), (text.hash_answer(x), "a\n#### 1,234", "1234"),
        (text.tool_name(x), "9-get.item", "tool_9_get_item"), (text.tool_name(x), "--", None), (text.shortened(x), "a" * 300, "a" * 128 + " ... " + "a" * 128), (text.feedback(x, F.lit(5)), "Guess: 7", "Too high"),
        (text.html_text(x), "<p>a &lt; b</p><script>no</script>", "a < b"), (text.normalized_answer(x), None, None),
    ]
    for expr, given_, want in cases:
        assert one(spark, expr, [(given_,)], "x string")[0].x == want
    assert [tuple(m) for m in one(spark, text.transcript(x), [("\n\nHuman: hi\n\nAssistant: yo",)], "x string")[0].x] == [("user", "hi"), ("assistant", "yo")]


@pytest.mark.parametrize("given_, want", [(r"\boxed{\frac{1}{2}} then \boxed{3}", "3"), (r"\boxed{a{b}c}", "a{b}c"), (r"\boxed{1", None), ("}", None), (r"\boxed 7", "7"), (None, None), ("", None)])
def test_boxed(given_, want):
    assert grading.boxed(given_) == want


@pytest.mark.parametrize("a, b, same", [("1,234", "1234", True), (r"\frac{1}{2}", "1/2", True), ("0.50", ".5", True), ("(1, 2)", "(1,2)", True), ("(1, 2]", "(1,2)", False), ("3", "4", False), (None, "1", False), (r"5\text{ cm}", "5", True)])
def test_grading(a, b, same):
    assert grading.same_answer(a, b) is same


# --- retrieval, events, rollouts, files, streams ----------------------------------------------------------------------


@pytest.mark.parametrize("block", [4096, 3])
def test_nearest_matches_brute_force(spark, block):
    rng = random.Random(1)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)] + [(60, None), (61, [0.0] * 8), (62, [1.0, 2.0])]
    df = spark.createDataFrame(data, "id bigint, v array<double>")
    got = {}
    for r in retrieval.nearest(df.where("id % 7 = 0"), df, "id", "v", 3, block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.neighbour_id))
    norm = lambda v: sum(x * x for x in v) ** 0.5
    for i, v in data[:60:7]:
        best = sorted((-(sum(a * b for a, b in zip(v, w)) / norm(v) / norm(w)), j) for j, w in data[:60] if j != i)[:3]
        assert [j for _, j in sorted(got[i])] == [j for _, j in best]


def test_event_buffers(spark):
    df = spark.createDataFrame([("a", i) for i in range(250)] + [("b", 0)], "job string, off bigint")
    assert events.ring(df, "job", "off").count() == 201
    got = {r.job: (r.n, r.next, r.truncated) for r in events.since(df, "job", "off", 10).collect()}
    assert got == {"a": (200, 250, True), "b": (0, 1, False)}


def test_tools_fail_as_messages():
    tools = rollout.ToolRegistry()
    tools.add("f", lambda q: {"q": q})
    tools.add("g", lambda: 1 / 0)
    with pytest.raises(ValueError):
        tools.add("f", print)
    assert tools.run("f", '{"q": "é"}') == '{"q": "é"}' and tools.run("x", "{}").startswith("Unknown tool") and tools.run("f", "[").startswith("Bad") and tools.run("f", "[]").startswith("Bad") and tools.run("g", "{}").startswith("Tool failed")
    turns = rollout.tool_rollouts(rollout.StubBackend(99), [rollout.opening("p", "s")], tools, 3)[0]
    assert len(turns) == 2 + 3 * 2


def test_rollouts_leave_failures_out(spark):
    class Half:
        def chat_batch(self, conversations, tools):
            return [{"content": "ok"} if "good" in c[-1]["content"] else None for c in conversations]

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "id bigint, prompt string")
    assert rows(rollout.generate(df, "id", lambda r: rollout.text_rollouts(Half(), r)).select("id")) == {(1,)}


def test_files(spark, tmp_path):
    meta = files.write_jsonl(spark.range(3), f"{tmp_path}/out", {"id": "j"})
    assert meta["records"] == 3 and json.loads(open(f"{tmp_path}/out.metadata.json").read())["records"] == 3
    assert files.write_jsonl(spark.range(0), f"{tmp_path}/none")["records"] == 0
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n   \n{"a": 2}\n')
    assert [r.a for r in files.read_jsonl_lenient(spark, f"{tmp_path}/x.jsonl", "a int").collect()] == [1, 2]
    (tmp_path / "y.jsonl").write_text('{"a": 1}\nbroken\n')
    assert {(r.a, r.raw) for r in files.read_results(spark, f"{tmp_path}/y.jsonl", "a int").collect()} == {(1, None), (None, "broken")}
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ"):
        files.read_jsonl(spark, f"{tmp_path}/y.jsonl", "a int").collect()
    assert [r.id for r in files.read_split(spark.range(10), "train[3:5]", "id").collect()] == [3, 4]
    assert files.prompt_records(spark.createDataFrame([("q", "old", 1)], "x string, prompt string, z int"), "x").columns == ["prompt", "z"]
    with pytest.raises(ValueError):
        files.read_split(spark.range(3), "train[", "id")


def test_streams(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i % 2}", f"2024-01-01 00:{i:02d}:00", float(i)) for i in range(20)], "id bigint, k string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    for part in range(4):
        df.where(F.col("id") % 4 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/events.parquet")
    stream = lambda: jobs.stream_parquet(spark, f"{tmp_path}/in", "events")
    got, published = [], []
    n = jobs.run_to_end(stream(), f"{tmp_path}/cp", lambda b, i: got.append(b.count()), published.append, 2)
    assert n == 4 and sum(got) == 20 and published == [1, 3]
    assert jobs.run_to_end(stream(), f"{tmp_path}/cp", lambda b, i: got.append(b.count())) == 0
    out = []
    jobs.run_to_end(jobs.count_windows(stream(), "k", "id", 4), f"{tmp_path}/cp2", lambda b, i: out.extend(map(tuple, b.collect())))
    assert sorted((k, b, n) for k, b, _, n in out) == [(k, b, 4) for k in ("k0", "k1") for b in (0, 1)]
    batch = rows(events.windowed(df, "ts", "5 minutes", "1 hour", "k").select("k", "n", "total"))
    seen = []
    jobs.run_to_end(events.windowed(stream(), "ts", "5 minutes", "1 hour", "k"), f"{tmp_path}/cp3", lambda b, i: seen.append(rows(b.select("k", "n", "total"))), mode="complete")
    assert seen[-1] == batch


# --- entry ------------------------------------------------------------------------------------------------------------


def test_entry_lists_everything():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "p5_found" in entry.queries()
    assert os.path.exists("/root/testdata") is False or len(entry.queries()) > 90


def test_hash_answer_has_no_longest_line(spark):
    from millrace.functions.text import hash_answer

    df = spark.createDataFrame([("x\n#### " + "7" * 1_200_000,), ("#### 1,234",), ("####",), ("none",)], "t string")
    assert [r[0] for r in df.select(hash_answer(df.t)).collect()] == ["7" * 1_200_000, "1234", "", None]


# --- numbers of rows that carry more than their key ---------------------------------------------------------------------


def test_numbers_are_dense_with_payload_and_many_input_files(spark, tmp_path):
    n = 1_000_000
    at = str(tmp_path / "rows")
    spark.range(0, n, 1, 8).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("k"), "id", (F.col("id") % 3 * F.col("id") % 7).alias("g"), F.md5(F.col("id").cast("string")).alias("payload"), F.lit(1).alias("one")).write.parquet(at)
    df = spark.read.parquet(at)
    got = sampling.numbered(df, [F.col("k"), F.col("id")]).select("idx", "k", "payload").agg(F.countDistinct("idx"), F.min("idx"), F.max("idx"), F.count("payload")).first()
    assert tuple(got) == (n, 0, n - 1, n)
    within = sampling.numbered_within(df, "g", [F.col("k"), F.col("id")]).groupBy("g").agg((F.countDistinct("idx") == F.count("payload")) & (F.min("idx") == 0) & (F.max("idx") == F.count("payload") - 1)).collect()
    assert len(within) > 3 and all(ok for _, ok in within)
    total = sampling.running_total(df, [F.col("k"), F.col("id")], "one").agg(F.countDistinct("running"), F.min("running"), F.max("running"), F.count("payload")).first()
    assert tuple(total) == (n, 1, n, n)


def test_tools_encoded_six_times_over():
    import json

    from millrace.operators.nested import declared

    text = json.dumps([{"name": "find"}])
    for _ in range(6):
        text = json.dumps(text)
    assert declared(text) == [{"name": "find"}]


def test_divergences_by_source_read_the_conversations_once(spark, tmp_path):
    import duckdb

    from millrace.plans import training as plans

    # repeated deliveries with other sources, a null source, an empty conversation
    data = [(1, "a", [msg("assistant", "one two")], "2024-01-01"), (1, "b", [msg("assistant", "one two three")], "2024-01-02"), (2, None, [msg("user", "x"), msg("assistant", "four")], None), (3, "b", [], None), (4, "b", [msg("assistant", "five"), msg("assistant")], None), (None, "c", [msg("assistant", "six")], None)]
    df = spark.createDataFrame(data, f"chat_id bigint, source string, messages array<{MESSAGE}>, at string").withColumn("ingested_at", F.to_timestamp("at")).drop("at")
    df.coalesce(1).write.parquet(str(tmp_path / "chats.parquet"))
    got = plans.distill_kl(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW chats AS SELECT * FROM '{tmp_path}/chats.parquet/*.parquet'")
    assert rows(got) == set(db.execute(plans.ORACLE["distill_kl"]).fetchall()) and got.count() == 2
    # the conversations and their repeated deliveries, no more
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
