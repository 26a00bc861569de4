"""Operators on text against brute force, on small fixtures with nulls, empty, long, repeated and tied rows."""

import itertools
import os
import random
import re
import unicodedata

import pytest

from millrace.llm import cuts, defects, leaks, lookups, packing, residue, similar, spans
from millrace.llm.components import buckets, components
from millrace.llm.endings import judge
from millrace.llm.residue_rules import labels

WORDS = "amber birch cedar delta ember flint grove heron inlet jetty knoll lemon maple north ocean pearl quartz river stone tulip".split()


def text(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(90)) if rng.random() < 0.4 else "") for _ in range(n))


def rows(df):
    return set(map(tuple, df.collect()))


# --- components -------------------------------------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (201, 200), (200, 202)]
    got = dict(rows(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[202] == 200
    assert rows(components(spark.createDataFrame([], "a bigint, b bigint"))) == set()


def test_buckets_are_the_same_with_hot_keys(spark):
    rng = random.Random(1)
    posted = spark.createDataFrame([(rng.choice([1, 1, 2, *range(3, 40)]), i) for i in range(300)], "key bigint, id bigint")
    assert rows(buckets(posted, posted).select("key", "id", "first", "n")) == rows(buckets(posted, posted.limit(0)).select("key", "id", "first", "n"))


# --- 1: cut texts -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "role, text, verdict",
    [
        ("assistant", "All is well.", "complete"), ("assistant", None, "complete"), ("assistant", "  \n", "complete"), ("assistant", "Marvin", "complete"), ("assistant", "No.", "complete"),
        ("assistant", "It ends here. [12]", "complete"), ("assistant", "He said: \"Done.\"", "complete"), ("assistant", "One step and so on...", "complete"), ("assistant", "The first pa...", "cut"),
        ("assistant", "Code:\n```python\nx = 1", "cut"), ("assistant", "Code:\n```python\nx = 1\n```", "complete"), ("tool", '{"a": [1, 2', "cut"), ("tool", '{"a": [1, 2]}', "complete"),
        ("assistant", "It weighs approx.", "cut"), ("user", "how do i sort this list of names", "complete"), ("assistant", "Steps:\n1. Mix\n2.", "cut"), ("assistant", "Sum:\n12 + 30 = 4", "cut"),
        ("assistant", "| a | b |\n|---|---|\n| 1 | 2 |", "complete"), ("assistant", "| a | b |\n|---|---|\n| 1 | ", "cut"),
    ],
)
def test_endings(role, text, verdict):
    assert judge(role, text)[0] == verdict


def test_cut_texts_are_found(spark):
    rng = random.Random(4)
    sentence = lambda: text(rng, 12).capitalize() + "."
    whole = {i: " ".join(sentence() for _ in range(4)) for i in range(200)}
    cut = {1000 + i: whole[i][: rng.randrange(90, len(whole[i]) - 2)].rstrip(". ") + " am" for i in range(40)}
    # a near-copy tells where the end is complete by itself
    copies = {2000 + i: whole[100 + i].rsplit(" ", 2)[0] for i in range(10)}
    data = [(i, "assistant", t) for i, t in (whole | cut | copies).items()] + [(3000, "assistant", None), (3001, "assistant", ""), (None, "assistant", "x y z"), (3002, "assistant", "a. " * 50_000)]
    got = {r[0] for r in cuts.cut_texts(spark.createDataFrame(data, "id bigint, role string, text string").withColumn("n", cuts.F.lit(1))).collect()}
    assert set(cut) <= got and set(copies) <= got and len(got - set(cut) - set(copies)) == 0
    assert cuts.cut_texts(spark.createDataFrame([], "id bigint, role string, text string")).count() == 0


def test_lines_cut_inside_a_word_stay_cut_however_often(spark):
    rng = random.Random(8)
    sentence = lambda: text(rng, 12).capitalize() + "."
    data = [(i, f"{sentence()}\nMost of the {rng.choice(WORDS)} is sold {sentence()}\n{sentence()}") for i in range(60)]
    data += [(100 + i, f"{sentence()}\nMost of th") for i in range(5)]
    # a line that nothing goes on from ends texts, but not for its copies alone
    data += [(200 + i, f"{sentence()}\nwith kind regards, yours") for i in range(5)] + [(300 + i, "It is a short note.\nleft on the tab") for i in range(5)]
    got = {r[0] for r in cuts.cut_texts(spark.createDataFrame([(i, "assistant", t) for i, t in data], "id bigint, role string, text string")).collect()}
    assert got == {100 + i for i in range(5)} | {300 + i for i in range(5)}


def test_begun_lines_match_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        pool = sorted({"".join(rng.choice("ab ") for _ in range(rng.randrange(1, 6))).strip() or "a" for _ in range(12)})
        x = "".join(rng.choice("ab ") for _ in range(8)).strip()
        flat = " ".join(x.split())
        assert cuts.begins(pool, x) == {i for i, y in enumerate(pool) if flat.startswith(y) and re.search(r"\w", flat[len(y) :])}


def test_cut_copies_are_found_beside_a_longer_variant_and_deep_cuts(spark):
    rng = random.Random(14)
    head = " ".join(text(rng, 12).capitalize() + "." for _ in range(3))
    # a family: the longest has another end, so only the variant itself tells where its copy stops
    data = [(i, f"{head} {text(rng, 12).capitalize()}.") for i in range(30)] + [(90, f"{head} {text(rng, 40).capitalize()}.")]
    data += [(100 + i, data[i][1][: len(head) + 40]) for i in range(10)]
    # cut at a fifth of the copy
    long = {200 + i: " ".join(text(rng, 12).capitalize() + "." for _ in range(12)) for i in range(10)}
    data += list(long.items()) + [(300 + i, t[: len(t) // 5]) for i, t in enumerate(long.values())]
    data = [(i, re.sub(r"\W+$", "", t) if i in range(100, 200) or i >= 300 else t) for i, t in data]
    data += [(400, "text text text text text text"), (401, "text text text text text text text text text")]  # filler, not cut
    by_id = dict(data)
    want = {i for i in by_id if (100 <= i < 200 or 300 <= i < 400) and any(t.startswith(by_id[i]) and cuts.goes_on(by_id[i], t, len(by_id[i])) for j, t in data if j != i)}
    got = {r[0] for r in cuts.early_copies(spark.createDataFrame(data, "id bigint, text string")).collect()}
    assert len(want) > 12 and got == want


def test_cut_copies_are_found_whatever_they_begin_with(spark):
    rng = random.Random(16)
    whole = [text(rng, 600).split() for _ in range(12)]
    # another beginning, of forty words; a beginning without words for 1 200 characters
    data = [(i, " ".join(w) + ".") for i, w in enumerate(whole[:6])] + [(100 + i, " ".join(text(rng, 40).split() + w[40:500])) for i, w in enumerate(whole[:6])]
    blob = ["".join(rng.choice("0123456789abcdef") for _ in range(1200)) for _ in range(6)]
    data += [(10 + i, f"{b} {' '.join(w)}.") for i, (b, w) in enumerate(zip(blob, whole[6:]))] + [(110 + i, f"{b} {' '.join(w[:50])}") for i, (b, w) in enumerate(zip(blob, whole[6:]))]
    got = {r[0] for r in cuts.early_copies(spark.createDataFrame(data, "id bigint, text string")).collect()}
    assert got == {*range(100, 106), *range(110, 116)}


def test_pairs_that_share_an_opening_and_an_end_are_not_all_held_against_each_other(spark, monkeypatch):
    rnd, n, pairs = random.Random(5), 40, []
    words = lambda k: " ".join("".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(k))
    start, end = words(45) + " ", " and the parcel has been handed over to the courier at the gate of the"
    data = [(i, start + words(300) + end) for i in range(n)] + [(100 + i, start + words(300) + end + " house " + words(10)) for i in range(n)]
    whole = start + words(300) + end
    data += [(200, whole), (201, whole + " house " + words(10))]
    confirmed = cuts.confirmed
    monkeypatch.setattr(cuts, "confirmed", lambda p, texts: (pairs.append(p.count()), confirmed(p, texts))[1])
    assert {r[0] for r in cuts.early_copies(spark.createDataFrame(data, "id bigint, text string")).collect()} == {200}
    assert 0 < sum(pairs) <= 10 * n  # not all n * n


def test_shingles_rule_out_no_pair_that_holds(spark):
    rnd, rows, held = random.Random(6), [], 0
    for k in range(300):
        x = rnd.choices([f"w{i}" for i in range(rnd.choice((5, 400)))], k=rnd.randint(6, 700))
        y = [w if rnd.random() > 0.02 * rnd.random() else "other" for w in x]
        short = " ".join(x) + " and here it was"
        long = " ".join(y) + " and here it was cut"
        if cuts.ends_early(short, long, long.rfind(" cut")):
            held += 1
            rows.append((k, *(v for t in (short, long[: long.rfind(" cut")]) for n, w in (cuts.shingled(t),) for v in (n, *w))))
    names = [p + c for p in ("own_", "") for c in ("n", *cuts._BITS)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"{c} {'int' if c.endswith('n') else 'bigint'}" for c in names))
    assert held > 100 and df.where(cuts.may_agree()).count() == held


def test_places_where_texts_go_on_match_brute_force():
    rnd, texts = random.Random(7), []
    for _ in range(60):
        texts.append("".join(rnd.choices(["ab ", "ab", " ", "\n", ",", ";", ".", "é", "a b a b a b a b a b a b "], k=40)))
    x, stop = cuts.Stretches(texts), cuts.np.cumsum([len(t) + 1 for t in texts])
    for t, end in zip(texts, stop):
        at = cuts.np.arange(1, len(t))
        assert x.goes[at + end - len(t) - 1].tolist() == [cuts.goes_on(t[:i], t, i) for i in at]
    row = cuts.np.repeat(cuts.np.arange(len(texts)), 20)
    place = cuts.np.array([rnd.randint(40, len(texts[r]) - 1) for r in row])
    start, size = (stop - [len(t) + 1 for t in texts])[row], cuts.np.array([len(t) for t in texts])[row]
    own, tail = cuts.mixed(cuts.np.arange(len(row), dtype=cuts.U)), x.of(start + place - cuts.TAIL, start + place)

    class Wanted:
        values = own + cuts.mixed(tail)

        def among(self, v):
            return cuts.np.flatnonzero(cuts.np.isin(v, self.values))

    hit, to, _ = cuts.going_on(x, Wanted(), own, place, start, size, True)
    both = cuts.going_on(x, Wanted(), own, place, start, size, False)
    assert both[0].tolist() == hit.tolist() and both[1].tolist() == to.tolist()
    want = {i: p for i, (r, at) in enumerate(zip(row, place)) if (p := cuts.where_it_goes_on(texts[r][:at], texts[r], at)) is not None}
    assert dict(zip(hit.tolist(), to.tolist())) == want and len(want) > 300


def test_sketches_of_words_before_a_place():
    rng = random.Random(17)
    texts = [text(rng, rng.randrange(8, 60)) for _ in range(20)] + ["", "İÇ Straße ÉTÉ " * 5]
    all_ = cuts.Sketches(texts)
    for i, t in enumerate(texts):
        for at in range(40, len(t), 7):
            # a text cut there has the same bands
            own = cuts.Sketches(["x y z", t[:at]])
            n = own.size[1] - 1
            rows = cuts.np.array([i])
            assert all_.before(rows, cuts.np.array([at]))[0] == n
            if n > 2:
                assert (all_.bands(rows, cuts.np.array([n]), 1) == own.bands(cuts.np.array([1]), cuts.np.array([n]), 1)).all()


def test_lookups_hold_what_was_written(spark, monkeypatch):
    for name, x in (("PART", 64), ("LEAST", 4), ("MOST", 12)):
        monkeypatch.setattr(lookups, name, x)
    rng = random.Random(3)
    own = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(1000)] + [-1, 0, 1, (1 << 63) - 1, -(1 << 63)]
    known = lookups.Values(lookups.written(spark.createDataFrame([(x,) for x in own * 2] + [(None,)], "x bigint"), 1000))
    asked = own + [rng.randrange(-(1 << 63), 1 << 63) for _ in range(5000)] + [x + 1 for x in own[:1000]]
    got = known.among(cuts.np.array(asked, cuts.np.int64).view(cuts.U))
    assert len(known.parts) > 10 and not known.flat and got.tolist() == [i for i, x in enumerate(asked) if x in set(own)]


def test_the_driver_holds_no_ends_and_no_lines(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("read to the driver")

    rng = random.Random(15)
    whole = [text(rng, 60) + "." for _ in range(10)]
    data = [(i, "assistant", t) for i, t in enumerate(whole)] + [(100 + i, "assistant", f"{t[:200]}") for i, t in enumerate(whole)] + [(200 + i, "assistant", f"{t}\nMost of the {i}") for i, t in enumerate(whole)]
    df = spark.createDataFrame(data, "id bigint, role string, text string")
    for kind, name in ((type(df), "toLocalIterator"), (type(spark.sparkContext), "broadcast")):
        monkeypatch.setattr(kind, name, refuse)
    monkeypatch.setattr(cuts, "PAIRED", -1)
    monkeypatch.setattr(cuts.F, "broadcast", refuse)
    got = {r[0] for r in cuts.cut_texts(df).collect()}
    assert {100 + i for i, t in enumerate(whole) if cuts.ends_open(t[:200]) and cuts.goes_on(t[:200], t, 200)} <= got and not got & set(range(10))


# --- 2: near-equal records --------------------------------------------------------------------------------------------


def brute_groups(data, k=3, least=0.6):
    sets = {}
    for i, t in data:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least:
            parent[root(a)] = root(b)
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if root(a) == root(b)}


def test_groups_match_brute_force(spark):
    rng = random.Random(7)
    data = []
    for i in range(60):
        base = text(rng, 60).split()
        for j in range(rng.randrange(1, 5)):
            w = list(base)
            for _ in range(rng.randrange(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            data.append((i * 10 + j, " ".join(w)))
    data += [(5000, None), (5001, ""), (5002, "two words"), (5003, "two words"), (5004, data[0][1]), (5005, data[0][1].upper()), (5006, "w " * 30_000), (5007, "w " * 30_001)]
    df = spark.createDataFrame([(i, t, 1) for i, t in data] + [(None, "amber birch cedar delta", 2)], "id bigint, text string, group int")
    grouped = similar.groups(df)
    assert rows(similar.pairs_of(grouped)) == brute_groups(data)
    assert similar.groups(spark.createDataFrame([], "id bigint, text string")).count() == 0


# --- 3: defects -------------------------------------------------------------------------------------------------------


def test_held_out_accuracy():
    rng = random.Random(3)
    en = "The {} shows the {} that it was in the {} and how the {} is for the {}."
    de = "Der {} zeigt die {} und wie das {} bei dem {} für die {} ist."
    base = []
    for i in range(400):
        form = de if i % 4 == 0 else en
        make = lambda n: " ".join(form.format(*[rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(5)]) for _ in range(n))  # noqa: B023, E731
        base.append((i, make(2)[:-1] + "?", make(4)))
    made = defects.training(base)
    x, y = defects.dense_of([m[:2] for m in made]), [[m[2] == d for d in defects.DEFECTS] for m in made]
    y = defects.np.array(y, defects.np.float32)
    held = defects.np.arange(len(made)) % 4 == 3
    w, b = defects.fit(x[~held], y[~held])
    limit = defects.calibrated(x[held] @ w + b, y[held])
    for k, d in enumerate(defects.DEFECTS):
        if d != "truncated":  # decided by how a response ends, which is joined
            said = (x[held] @ w + b - limit)[:, k] > 0
            assert (said == (y[held][:, k] > 0)).mean() > 0.97, d
    assert abs(defects.scores_of([m[:2] for m in made[:50]], w, b) - (x[:50] @ w + b)).max() < 1e-3


def test_no_training_phrase_stands_in_the_test_data():
    pq = pytest.importorskip("pyarrow.parquet")
    at = "/root/testdata/sf0.1/rollouts.parquet"
    if not os.path.exists(at):
        pytest.skip("no test data")
    said = "\n".join(x.lower() for x in pq.read_table(at, columns=["content"]).column(0).to_pylist() if x)
    phrases = [p.strip(" .,;:").lower() for parts in defects.REFUSALS.values() for part in parts for p in part] + [p.strip(".").lower() for p in defects.HARMLESS]
    assert not [p for p in phrases if len(p.split()) > 2 and p in said]


def test_refusals_of_a_language_never_trained_on_are_mostly_found():
    rng = random.Random(6)
    base = [(i, " ".join([text(rng, 12), "the of and to is"]) + "?", " ".join(f"The {text(rng, 9)} of the and to is." for _ in range(4))) for i in range(300)]
    kept = dict(defects.REFUSALS)
    for lang in ("de", "fr", "es"):
        defects.REFUSALS[lang] = kept["en"]
        try:
            made = defects.training(base + defects.plain_pairs())
        finally:
            defects.REFUSALS[lang] = kept[lang]
        x, y = defects.dense_of([m[:2] for m in made]), defects.np.array([[m[2] == d for d in defects.DEFECTS] for m in made], defects.np.float32)
        held = defects.np.arange(len(made)) % defects.HELD == defects.HELD - 1
        w, b = defects.fit(x[~held], y[~held])
        limit = defects.calibrated(x[held] @ w + b, y[held])
        asked = [(base[i][1], defects.refusal(rng, lang, False)) for i in range(100)]
        assert ((defects.dense_of(asked) @ w + b - limit)[:, 2] > 0).mean() > 0.5, lang


def test_defects_of_odd_rows(spark):
    rng = random.Random(5)
    data = [(i, text(rng, 30).capitalize() + "?", " ".join(text(rng, 12).capitalize() + "." for _ in range(4))) for i in range(120)]
    data += [(900, None, None), (901, "Why?", ""), (902, None, "It is so."), (903, "Why is it so?", "<think>hm</think>"), (904, data[0][1], data[0][1]), (None, "a", ""), (905, "Why?", "word " * 40_000 + "end.")]
    got = dict(rows(defects.defective(spark.createDataFrame([(*r, 1) for r in data], "id bigint, prompt string, content string, defect int"))))
    assert [got.get(i) for i in (900, 901, 903, 904)] == ["empty", "empty", "empty", "copied"] and None not in got
    assert defects.defective(spark.createDataFrame([], "id bigint, prompt string, content string")).count() == 0


# --- 4: residue -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "role, text, before, found",
    [
        ("user", "Hello {{ name }}!", None, True), ("user", "Use ${topic} here.", None, True), ("assistant", "Dear [INSERT NAME],", None, True), ("assistant", "Dear [Your Name],", "Give me a letter template.", False),
        ("assistant", "```\n{{ name }}\n```", None, False), ("user", "My Jinja file prints nothing for {{ name }}.", None, False), ("assistant", "Lorem ipsum dolor sit amet.", None, True),
        ("user", "What does lorem ipsum mean?", None, False), ("tool", '{"status": 404, "error": "Not Found"}', None, False), ("assistant", "HTTP 404\n\nNothing to see.\n\nBack to the start page", None, True),
        ("assistant", "A 404 means the server answered Not Found. Try another page.", None, False), ("assistant", "Please turn on JavaScript and cookies to go on.", None, True),
        ("assistant", "The set ${a, b}$ is left out.", None, False), ("assistant", None, None, False), ("assistant", "Plain words only.", None, False),
    ],
)
def test_trusted_labels(role, text, before, found):
    assert any(v > 0 for _, v in labels(role, text, before)) == found


MESSAGES = "array<struct<role:string,content:string>>"


def test_residue_spreads_to_near_lines(spark):
    page = "Forbidden. The shop is closed for repairs until further notice today, friends. Reference: 2a8ede88"
    data = [
        (1, [("user", "Hi."), ("assistant", page)]), (2, [("assistant", "The shop is closed for repairs until further notice today, friends!")]), (3, [("assistant", "The shop sells bread.")]),
        (4, None), (5, []), (6, [None, ("user", None), ("user", " ")]), (None, [("user", "{{ a_b }}")]), (7, [("user", "{{ a_b }}"), ("user", "{{ a_b }}")]), (8, [("assistant", "pebble " * 50_000)]),
        # in a line with other things it is told, not shown
        (9, [("assistant", "The sign said this. The shop is closed for repairs until further notice today, friends!")]), (10, [("assistant", "#### 503")]), (11, [("assistant", "#### 404"), ("user", "77")]),
    ]
    df = spark.createDataFrame(data, f"id bigint, m {MESSAGES}").withColumn("mark", residue.F.lit(0))
    assert rows(residue.residue(df, "id", "m")) == {(1, 1), (2, 0), (7, 0), (7, 1)}
    assert rows(residue.judged(df, "id", "m").where("not ruled").select("rec", "pos")) == {(2, 0)}
    assert residue.residue(df.limit(0), "id", "m").count() == 0


def test_residue_spreads_over_a_replaced_word_and_along_chains(spark):
    page = "The old mill shop is closed for repairs until further notice, so please come back to the harbour office after the winter holidays"
    said = [page.replace("further", "later"), page.replace("winter", "long winter"), page.replace("please ", ""), page.replace("repairs", "painting"), page.replace("repairs", "painting").replace("harbour", "station")]
    data = [(0, [("assistant", f"Oops! {page}. (code 503)")])] + [(1 + i, [("user", "Hi."), ("assistant", t)]) for i, t in enumerate(said)] + [(9, [("assistant", "The old mill shop sells bread until the winter holidays.")])]
    got = rows(residue.residue(spark.createDataFrame(data, f"id bigint, m {MESSAGES}"), "id", "m"))
    assert got == {(0, 0)} | {(1 + i, 1) for i in range(len(said))}
    # one of them quoted as a line with a field that the message talks about: the component is left alone
    sound = (20, [("assistant", f"{said[3]}. The variable {{{{ shop }}}} prints this.")])
    got = rows(residue.residue(spark.createDataFrame(data + [sound], f"id bigint, m {MESSAGES}"), "id", "m"))
    assert got == {(0, 0)}


def test_clean_twins_of_lines_with_fields_stay_clean(spark):
    rng = random.Random(8)
    lines = [f"Which of the {rng.randrange(99)} {text(rng, 9)} should come first, and why?" for _ in range(1000)]
    data = [(i, [("user", x)]) for i, x in enumerate(lines)] + [(5000 + i, [("user", " ".join(w[:3] + ["{{ a_field }}"] + w[3:]))]) for i, x in enumerate(lines) for w in (x.split(" "),)]
    assert rows(residue.residue(spark.createDataFrame(data, f"id bigint, m {MESSAGES}"), "id", "m")) == {(5000 + i, 0) for i in range(len(lines))}


def test_tables_find_what_brute_force_finds():
    rng = random.Random(3)
    base = [text(rng, rng.randrange(8, 30)) for _ in range(120)]
    lines = list(base)
    for x in base * 3:
        w = x.split()
        i = rng.randrange(len(w))
        kind = rng.randrange(3)
        w[i : i + (kind != 1)] = [] if kind == 0 else ["indigo"]
        lines.append(" ".join(w))
    *_, mark, start, end, y = residue.sentences_of([re.sub(r"\d+", "", x) for x in lines])
    sims = residue.sims_of(y, start, end, mark)
    row, own = residue.Tables(sims).near(sims)
    met = set(zip(row.tolist(), own.tolist()))
    said = [y[a:b].tobytes().decode("utf-32-le") for a, b in zip(start, end)]
    grams = [{t[i : i + 5] for i in range(max(1, len(t) - 4))} for t in said]
    near = [(i, j) for i, j in itertools.combinations(range(len(lines)), 2) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    assert len(near) > 300 and sum(p in met for p in near) >= 0.97 * len(near)
    assert [residue.sims_of(y, start[i : i + 1], end[i : i + 1], mark[i : i + 1])[0] for i in range(5)] == sims[:5].tolist()


def test_the_front_in_several_passes_finds_the_same(spark, monkeypatch):
    data = [(i, [("assistant", f"Oops! {x}. (code 503)"), ("user", f"{x} soon")]) for i, x in enumerate(text(random.Random(i), 16) for i in range(12))]
    df = spark.createDataFrame(data, f"id bigint, m {MESSAGES}")
    every = rows(residue.residue(df, "id", "m"))
    monkeypatch.setattr(residue, "FRONT", 5)
    monkeypatch.setattr(residue, "BROADCAST_MARKS", 1)
    assert rows(residue.residue(df, "id", "m")) == every and len(every) == 24


# --- 6: packing -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("method", ["planned", "harmonic"])
def test_packing_holds_its_limits(spark, method):
    rng = random.Random(2)
    counts = [(i, rng.choice([1, 2, 3, 5, 8, 13, 64, 64, 64, 90, 333])) for i in range(500)] + [(900, 0), (901, 0)]
    limits = spark.createDataFrame([(1, 64), (2, 100), (3, None), (4, 0)], "limit_id int, capacity bigint")
    df = spark.createDataFrame(counts, "id bigint, n_tokens bigint")
    got = packing.pack(df, limits, method=method).collect()
    caps, size = {1: 64, 2: 100}, dict(counts)
    load, whole = {}, {}
    for r in got:
        load[r.limit_id, r.seq] = load.get((r.limit_id, r.seq), 0) + r.n_tokens
        whole.setdefault((r.limit_id, r.id), []).append((r.piece, r.from_token, r.n_tokens))
    assert all(v <= caps[k] for (k, _), v in load.items()) and set(whole) == {(k, i) for k in caps for i, _ in counts}
    for (k, i), parts in whole.items():
        parts.sort()
        assert sum(p[2] for p in parts) == size[i] and len(parts) == max(1, -(-size[i] // caps[k])) and all(p[1] == p[0] * caps[k] for p in parts)
    for k, cap in caps.items():
        used = max(s for x, s in load if x == k) + 1
        # no packing needs fewer than this: neither the sum nor the pieces over half a sequence fit otherwise
        least = max(sum(size.values()) / cap, sum(r.n_tokens > cap / 2 for r in got if r.limit_id == k))
        assert used <= (1.05 if method == "planned" else 1.7) * least + 2
    assert packing.pack(df.limit(0), limits, method=method).count() == 0 and packing.pack(df, limits.limit(0), method=method).count() == 0


def test_token_counts(spark):
    got = dict(rows(packing.token_counts(spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (5, "a" * 30_000), (None, "x")], "id bigint, text string"), "id", "text")))
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1 and got[5] > 100 and None not in got


# --- 7: leaks ---------------------------------------------------------------------------------------------------------


def words_of(t):
    return re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", t or "").lower())


def test_leaks_match_brute_force(spark):
    rng = random.Random(9)
    items = [(i, text(rng, 30)) for i in range(20)] + [(50, "too short"), (51, None), (52, text(rng, 12)), (53, "Ｆｕｌｌ ½ width Straße " + text(rng, 14))]
    docs = [(i, text(rng, 80)) for i in range(40)]
    for i in range(40, 80):
        w = (rng.choice(items[:20])[1] or "").split()
        n, at = rng.randrange(8, 20), rng.randrange(0, 10)
        docs.append((i, text(rng, rng.randrange(0, 20)) + "\n" + "; ".join(w[at : at + n]).upper() + " " + text(rng, 5)))
    docs += [(90, None), (91, ""), (92, items[-1][1].lower()), (93, items[22][1] + " " + items[22][1]), (94, "x " * 60_000 + items[0][1])]
    runs = {}
    for i, q in items:
        w = words_of(q)
        for k in range(len(w) - 11):
            runs.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [words_of(t)] for k in range(len(w) - 11) for i in runs.get(tuple(w[k : k + 12]), ())}
    d, q = spark.createDataFrame(docs + [(None, items[0][1])], "id bigint, text string"), spark.createDataFrame(items, "item int, q string")
    exact = leaks.leaks(d, "id", "text", q, "item", "q")
    assert rows(exact.select("doc", "item")) == want
    assert rows(leaks.leaks(d, "id", "text", q, "item", "q", block=200).select("doc", "item")) == want
    loose = leaks.leaks(d, "id", "text", q, "item", "q", leaks.Search(edits=1, walks=4, samples=5))
    assert want <= rows(loose.select("doc", "item"))
    assert leaks.leaks(d.limit(0), "id", "text", q, "item", "q").count() == 0 and leaks.leaks(d, "id", "text", q.limit(0), "item", "q").count() == 0


def test_edited_passages_are_found():
    rng = random.Random(12)
    items = [(i, text(rng, 14)) for i in range(200)]
    docs = []
    for _, q in items:
        w = q.split()
        at = rng.randrange(2, 12)
        w = w[:at] + ([] if rng.random() < 0.5 else ["changed"]) + w[at + 1 :]
        docs.append(text(rng, 10) + " " + " ".join(w) + " " + text(rng, 10))
    how = leaks.Search(edits=2, walks=12, samples=5)
    index = leaks.index_of(items, how)
    hits = leaks.hits_in(docs, index, how)
    assert sum((i, i) in hits for i in range(200)) >= 180  # a recall of 0.9


# --- 8: spans ---------------------------------------------------------------------------------------------------------


def brute_spans(docs, span):
    seen = {}
    for i, t in docs:
        for s in range(len(t or "") - span + 1):
            seen.setdefault(t[s : s + span], set()).add(i)
    out = set()
    for i, t in docs:
        starts = [s for s in range(len(t or "") - span + 1) if len(seen[t[s : s + span]]) > 1]
        for s in starts:
            if (cur := max((x for x in out if x[0] == i), default=None, key=lambda x: x[2])) and s <= cur[2]:
                out.remove(cur)
                out.add((i, cur[1], s + span))
            else:
                out.add((i, s, s + span))
    return out


@pytest.mark.parametrize("few", [2048, 1])
def test_spans_match_brute_force(spark, few):
    rng = random.Random(21)
    pool = [text(rng, 30) for _ in range(6)] + ["é😀ß" * 40, "ab" * 90, "a" * 200]
    docs = []
    for i in range(60):
        parts = [text(rng, rng.randrange(0, 12)) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(pool)
            a = rng.randrange(0, 30)
            parts.insert(rng.randrange(len(parts)), p[a : a + rng.randrange(50, 200)])
        docs.append((i, "".join(parts)))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (103, pool[0] + pool[0]), (104, "z" * 300), (105, "solo " * 40 + "solo " * 40)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs] + [(None, pool[0], 1)], "doc bigint, text string, token int")
    got = spans.shared_spans(df, "doc", "text", span=60, gram=12, few=few)
    assert rows(got) == brute_spans(docs, 60)
    if few > 1:
        assert spans.shared_spans(df.limit(0), "doc", "text", span=60, gram=12).count() == 0
