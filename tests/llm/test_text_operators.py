import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import chat, licences, line_templates, mixing, order_minhash, toxicity
from marquee.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.conftest import MEDIUM, SMALL
from tests.llm.conftest import DOCS


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


WORDS = st.lists(st.integers(0, 4), max_size=14)


@settings(max_examples=500, deadline=None)
@given(WORDS, WORDS, st.integers(0, 12))
def test_banded_distance(a, b, most):
    want = edit_distance(a, b)
    assert order_minhash.banded_distance(a, b, most) == (want if want <= most else None)


def classes_by_brute_force(docs):
    words = [(r.doc_id, order_minhash.word_list(r.text)) for r in docs]
    root = {i: i for i, _ in words}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    words.sort(key=lambda x: len(x[1]))
    counts = [Counter(w) for _, w in words]
    for a, (i, w) in enumerate(words):
        for b in range(a + 1, len(words)):
            j, v = words[b]
            if len(w) < 0.8 * len(v):
                break
            if sum((counts[a] & counts[b]).values()) >= 0.8 * len(v) and order_minhash.similarity(w, v) is not None:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in words}


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_near_classes_as_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = classes_by_brute_force(docs)
    got = {r.doc_id: r.class_id for r in QUERIES["op9_order_minhash"](spark, folder).collect()}
    assert len(got) == len(docs)
    assert sum(got[i] != want[i] for i in want) <= 0.01 * len(want)
    assert all(want[i] == want[c] for i, c in got.items())


def test_large_group_and_shared_passages(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    base = rng.choices(words, k=120)
    shared = rng.choices(words, k=60)
    rows = []
    for i in range(150):  # near copies of one text
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    for i in range(150, 220):  # different texts with one passage in common
        rows.append((i, " ".join(rng.choices(words, k=50) + shared + rng.choices(words, k=50))))
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOCS)
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(docs).collect()}
    assert {got[i] for i in range(150)} == {0} and all(got[i] == i for i in range(150, 220))


def test_near_copies_of_odd_rows(spark, odd_docs, no_docs):
    rows = order_minhash.near_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.class_id)
    assert by_id[4] == {4} and by_id[5] == {4} and by_id[1] == by_id[2] == by_id[7] == {1} and by_id[None] == {None}
    kept = order_minhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    assert order_minhash.near_classes(no_docs).count() == 0 and order_minhash.keep_first(no_docs).count() == 0


def test_short_near_copies_meet(spark):
    """Texts of up to 14 words: every pair of similarity 0.8 or more is linked, also prefixes and words changed in the middle."""
    rng = random.Random(6)
    rows, pairs = [], []
    for n in range(4, 15):
        for edits in range(1, int(0.2 * n + 1e-9) + 1):
            for kind in ("cut", "change", "put", "mixed"):
                base = [f"g{len(rows)}w{i}" for i in range(n)]
                copy = list(base)
                for e in range(edits):
                    at = rng.randrange(len(copy))
                    if kind == "cut":
                        copy.pop()
                    elif kind == "put" or (kind == "mixed" and e % 2):
                        copy.insert(at, f"new{e}")
                    else:
                        copy[at] = f"other{e}"
                if len(copy) <= 14 and order_minhash.similarity(base, copy) is not None:
                    pairs.append((len(rows), len(rows) + 1))
                rows += [" ".join(base), " ".join(copy)]
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(line_docs(spark, rows)).collect()}
    assert len(pairs) > 40 and all(got[a] == got[b] for a, b in pairs)
    members = [f"same four words then {'abcdefghij'[i % 10]}{i}" for i in range(600)]  # each pair at 0.8 in one large bucket
    got = {r.class_id for r in order_minhash.near_classes(line_docs(spark, members)).collect()}
    assert got == {0}


def planted_recall(similarity, n=300, pairs=400):
    """Share of planted pairs, words changed at random places, that share a pick."""
    rng = np.random.default_rng(7)
    hits = 0
    for _ in range(pairs):
        a = rng.integers(1, 1 << 62, n).astype(np.uint64)
        b = a.copy()
        b[rng.choice(n, round((1 - similarity) * n), replace=False)] = rng.integers(1, 1 << 62, round((1 - similarity) * n))
        one, two = (order_minhash.sketch(order_minhash.labelled_shingles(x)) for x in (a, b))
        hits += bool((one == two).any())
    return hits / pairs


def test_planted_pairs_meet():
    assert planted_recall(0.80) >= 0.85 and planted_recall(0.85) >= 0.98 and planted_recall(0.90) >= 0.99


# --- line templates ---------------------------------------------------------------------------------------


def line_docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)


def test_recurring_templates_go(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}x{chr(97 + i // 26)}" for i in range(60))
    menu = "visited the main page on {} by some user of our small site"
    texts = [f"own line of {n}\n{passage}\n{menu.format(f'day{n} 1{n}:00')}\nlast" for n in ("one", "two", "six")]
    changed = passage.replace("worddxa", "changed")
    texts += [f"quite another start\n{changed}", "nothing that anyone else has said in any other place\nend", None, ""]
    rows = {r.doc_id: r.text for r in line_templates.drop_recurring(line_docs(spark, texts)).collect()}
    assert rows[0] == texts[0] and rows[1] == "own line of two\nlast" and rows[2] == "own line of six\nlast"
    assert rows[3] == "quite another start" and rows[4] == texts[4] and rows[5] is None and rows[6] == ""


def test_short_lines_need_four_documents(spark):
    texts = [f"all rights reserved.\nbody {'abcd'[n]} is alone" for n in range(4)] + ["see you soon\nx", "see you soon\ny"]
    rows = {r.doc_id: r.text for r in line_templates.drop_recurring(line_docs(spark, texts)).collect()}
    assert rows[0] == texts[0] and rows[3] == "body d is alone" and rows[5] == texts[5]


def test_numbers_alone_are_no_template(spark):
    texts = [f"{n} {n + 1} {n + 2} {n + 3} 5 6 7 8 9 10 11 12" for n in range(6)]
    assert sorted(r.text for r in line_templates.drop_recurring(line_docs(spark, texts)).collect()) == sorted(texts)


def lines_by_brute_force(docs):
    """The same rules on one machine: leaves, greedy templates, documents per template."""
    leaves, where = {}, {}
    for r in docs:
        for i, raw in enumerate((r.text or "").split("\n")):
            tokens = tuple("<*>" if any(c.isdigit() and c.isascii() or c == "@" for c in t) or "://" in t else t for t in raw.split())
            if len(tokens) >= 3:
                leaves.setdefault((len(tokens), tokens[:3]), {}).setdefault(tokens, set()).add((r.doc_id,))
                where.setdefault(tokens, []).append((r.doc_id, i))
    return leaves, where


def test_exact_recurrence_is_found_everywhere(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    leaves, where = lines_by_brute_force(docs.collect())
    must = set()
    for (n, _), lines in leaves.items():
        for tokens, own in lines.items():
            if len(own) >= (2 if n >= 10 else 4) and 2 * sum(t != "<*>" for t in tokens) >= n:
                first = min(own)[0]
                must |= {(d, i) for d, i in where[tokens] if d != first}
    single = {t for lines in leaves.values() if len(lines) == 1 for t in lines}
    alone = {(d, i) for t in single for d, i in where[t]}
    got = {(r.doc_id, r.line) for r in line_templates.recurring_lines(docs).collect()}
    assert must <= got
    assert got & alone == must & alone  # in leaves of one line there is nothing to generalise


def test_blocks_of_a_large_leaf(spark):
    rng = random.Random(2)
    texts = []
    for i in range(300):
        tail = [rng.choice("abcdefghij") * 3 for _ in range(9)]
        texts.append("one two three " + " ".join(tail))
    fixed = [f"{chr(97 + i)}{chr(97 + i)}q" for i in range(12)]
    for i in range(6):
        texts.append(" ".join(["one", "two", "three", *fixed[:4], f"field{chr(97 + i)}", *fixed[5:9]]))
    docs = line_docs(spark, texts)
    small = {(r.doc_id, r.line) for r in line_templates.recurring_lines(docs, most=20).collect()}
    assert {(i, 0) for i in range(301, 306)} <= small


@pytest.mark.parametrize("n", [12, 20])
def test_size_of_a_leaf_changes_nothing(spark, n):
    """Fields in as many segments as the threshold allows, in a leaf whose lines all share some further tokens too."""
    rng = random.Random(n)
    lead = ["one", "two", "three"]
    texts = [" ".join([*lead, "four", *[rng.choice("abcdefghij") * 3 for _ in range(n - 4)]]) for _ in range(300)]
    places = range(4, n, 4)[: n // 5]
    for family in range(12):
        words = [f"{chr(97 + family)}{chr(97 + i)}q" for i in range(n - 4)]
        for i in range(2):
            line = [*lead, "four", *words]
            for p in places:
                line[p] = f"field{chr(97 + i)}"
            texts.append(" ".join(line))
    docs = line_docs(spark, texts)
    whole, blocks = ({(r.doc_id, r.line) for r in line_templates.recurring_lines(docs, most=m).collect()} for m in (2000, 10))
    assert whole == blocks and {(301 + 2 * f, 0) for f in range(12)} <= whole


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    rows = line_templates.drop_recurring(odd_docs).collect()
    assert len(rows) == odd_docs.count() and line_templates.drop_recurring(no_docs).count() == 0
    assert {r.text for r in rows if r.doc_id in (1, 7)} == {None, " \n\n \t"}


# --- chat --------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_chat_as_sql(spark, folder):
    assert difference(QUERIES["op6_chat_snapshots"](spark, folder), connect(folder), ORACLES["op6_chat_snapshots"]) is None


def test_snapshots_collapse(spark):
    rows = []
    for conv in range(5):  # each a longer snapshot of one conversation
        rows += [(conv, t, "user", f"t{t}") for t in range(conv + 1)]
    rows += [(9, t, "user", f"t{t}") for t in range(5)] + [(7, 0, "user", "t0"), (7, 1, "user", "other")]
    rows += [(None, 0, "user", "x"), (8, None, None, None), (8, 0, "user", ""), (8, 0, "user", "")]
    turns = spark.createDataFrame(rows, TURNS)
    got = chat.formatted(turns).collect()
    assert {(r.conv_id, r.n_turns, r.copies) for r in got} == {(4, 5, 2), (7, 2, 1), (None, 1, 1), (8, 3, 1)}
    assert len(got) == 5 + 2 + 1 + 3
    text = {r.conv_id: r.text for r in chat.conversation_texts(chat.formatted(turns)).collect()}
    assert text[7] == "<|user|>\nt0\n<|end|>\n<|user|>\nother\n<|end|>\n"
    assert chat.formatted(turns.limit(0)).count() == 0


def test_blocks_of_turns_change_nothing(spark):
    rows = [(c, t, "user", f"{t % 3}") for c in range(6) for t in range(10 * c + 3)]
    turns = spark.createDataFrame(rows, TURNS)
    hashes = lambda block: sorted((r.conv_id, r.place, r.p1, r.p2) for r in chat.placed_turns(turns, block).collect())
    assert hashes(4) == hashes(4096)


def test_turns_without_numbers_and_repeats_are_split(spark):
    rows = [(None, None, "user", "same")] * 300 + [(None, None, "user", f"{i}") for i in range(200)] + [(1, 0, "user", "x")] * 50
    rows += [(2, 3, None, None)] * 40 + [(2, 3, "user", "")] * 40 + [(2, None, "user", "first")]
    turns = spark.createDataFrame(rows, TURNS)
    counted = chat.numbered_turns(turns, 40)
    assert counted.count() == 201 + 1 + 3
    for block, each in ((7, 40), (4096, 10**6)):
        got = {(r.conv_id, r.place): (r.role, r.text, r.p1, r.p2) for r in chat.placed_turns(turns, block, each).collect()}
        want = {}
        for conv in (None, 1, 2):
            least = lambda v: (v is not None, v if v is not None else "")
            own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, least(r[2]), least(r[3])))
            want |= {(conv, place): r[2:] for place, r in enumerate(own, 1)}
        assert {k: v[:2] for k, v in got.items()} == want
        if block == 7:
            small_blocks = got
    assert small_blocks == got


# --- mixing ------------------------------------------------------------------------------------------------


def targets_by_rounds(sizes, weights=(5.0, 2.0, 1.0)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 90, None: 5}, {"x": 1}, {"a": 0, "b": 7}, {f"s{i}": i * i for i in range(12)}, {"a": 0}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = targets_by_rounds(sizes)
    assert got == pytest.approx(want)


def test_mix_of_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in docs}
    size = {r.doc_id: len((r.text or "").split()) for r in docs}
    rows = QUERIES["op10_curriculum_mix"](spark, MEDIUM).collect()
    again = QUERIES["op10_curriculum_mix"](spark, MEDIUM).collect()
    assert sorted(rows) == sorted(again) and {r.doc_id: r.size for r in rows} == size and len(rows) == len(docs)
    taken, largest = Counter(), Counter()
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    for r in rows:
        assert abs(taken[source[r.doc_id]] - r.target) <= largest[source[r.doc_id]] / 2 + 1e-6


def test_positions_follow_the_schedule(spark):
    for schedule in mixing.SCHEDULES:
        knots = mixing.demand(schedule)
        time = np.linspace(0, 1, 21)
        share = []
        for t in time:
            t0, before, rate, slope = [k for k in knots if k[0] <= t][-1]
            share.append(before + rate * (t - t0) + slope * (t - t0) ** 2 / 2)
        frame = spark.createDataFrame([(float(s),) for s in share], "x double")
        got = [r.t for r in frame.select(mixing.inverse_demand(F.col("x"), schedule).alias("t")).collect()]
        assert got == pytest.approx(time.tolist(), abs=1e-9) and share[-1] == pytest.approx(1)


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    mixed = mixing.mix(odd_docs)
    positions = [r._position for r in mixed.collect()]
    assert positions == sorted(positions) and mixed.columns[:5] == odd_docs.columns
    planned = mixing.plan(odd_docs)
    assert planned.agg(F.sum("rows")).first()[0] == odd_docs.count()
    assert mixing.mix(no_docs).count() == 0


# --- toxicity ----------------------------------------------------------------------------------------------


def test_toxic_documents_are_found(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_toxicity_chain"](spark, MEDIUM).collect()}
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()
    toxic = [r.doc_id for r in labels if r.toxic]
    clean = [r.doc_id for r in labels if not r.toxic]
    assert sum(rows[i].is_toxic for i in toxic) >= 0.9 * len(toxic)
    assert sum(rows[i].is_toxic for i in clean) <= 0.01 * len(clean)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    chain = toxicity.fit(docs, labels.where(~held))
    tested = toxicity.scored(docs.select("doc_id", "text").join(labels.where(held), "doc_id"), chain).collect()
    hits = sum(r._toxic for r in tested if r.toxic) / sum(r.toxic for r in tested)
    false = sum(r._toxic for r in tested if not r.toxic) / sum(not r.toxic for r in tested)
    assert hits >= 0.92 and false <= 0.01


def test_later_models_learn_from_out_of_fold_logits():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    first = (x[:, 0] > 0).astype(float)
    chain = toxicity.fit_chain(x, np.c_[first, first], rng.integers(0, 5, 200), {str(i): i for i in range(5)})
    assert len(chain.weights[0]) == 6 and len(chain.weights[1]) == 7 and chain.weights[1][5] > 0
    assert ((chain.logits(x)[:, 1] > 0) == (first > 0)).mean() > 0.95


def test_fitting_holds_no_copies_of_the_features():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1000, 400))
    labels = np.repeat((x[:, :1] > 0).astype(float), 3, axis=1)
    tracemalloc.start()
    toxicity.fit_chain(x, labels, rng.integers(0, 5, 1000), {str(i): i for i in range(400)})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes / 2


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (5, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(odd_docs, labels)
    named = odd_docs.withColumn("_toxic", F.lit("mine"))
    assert toxicity.scored(named, chain).count() == odd_docs.count()
    assert toxicity.without_toxic(odd_docs, chain).columns == odd_docs.columns
    assert toxicity.scored(no_docs, chain).count() == 0
    unlabelled = toxicity.fit(odd_docs, labels.limit(0))
    assert toxicity.without_toxic(odd_docs, unlabelled).count() == odd_docs.count()
    assert toxicity.fit(no_docs, labels).share == 0


# --- licences ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier(spark):
    return licences.fit(spark)


def test_scan_of_documents(spark, classifier):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    notices = {
        "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "proprietary",
    }
    want = {(r.doc_id, i, notices[p]) for r in docs.collect() for i, p in enumerate(r.text.split("\n")) if p in notices}
    got = licences.scan(docs, classifier).collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got if r.confirmed} == want


def test_held_out_paragraphs(spark, classifier):
    rows = [(i, text, family) for i, (text, family, held) in enumerate(licences.examples()) if held]
    found = {r.doc_id: r.family for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string, f string"), classifier).collect()}
    known = [r for r in rows if r[2] != licences.UNKNOWN]
    others = [r for r in rows if r[2] == licences.UNKNOWN]
    assert sum(found.get(i) == f for i, _, f in known) >= 0.8 * len(known)
    assert all(found.get(i, f) == f for i, _, f in known)
    assert sum(i in found for i, _, _ in others) <= 0.05 * len(others)


def score_by_hand(classifier, text):
    total = np.array(classifier.intercepts)
    for term in set(licences._terms(text)):
        total = total + np.array(classifier.weights.get(term, [0.0] * len(total)))
    p = np.exp(total / classifier.temperature - (total / classifier.temperature).max())
    return p / p.sum()


def test_chances_by_hand(spark, classifier):
    texts = [t for family in licences.TEMPLATES.values() for t in family]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licences.scan(frame, classifier).collect():
        p = score_by_hand(classifier, texts[r.doc_id])
        assert r.probability == pytest.approx(p[:-1].max()) and r.family == classifier.families[int(p.argmax())] and r.confirmed


def test_licences_of_odd_rows(spark, odd_docs, no_docs, classifier):
    assert licences.scan(odd_docs, classifier).count() == 0 and licences.scan(no_docs, classifier).count() == 0
    twice = spark.createDataFrame([(1, "MIT license\nReleased under the MIT License.")] * 2, "doc_id long, text string")
    assert sorted(r.paragraph for r in licences.scan(twice, classifier).collect() if r.confirmed)[-2:] == [1, 1]


def wrapped(text, width, mark=""):
    lines, line = [], mark
    for w in text.split():
        if len(line) + len(w) >= width and line.strip() != mark.strip():
            lines.append(line)
            line = mark
        line += " " + w
    return [*lines, line]


@pytest.mark.parametrize("width, mark", [(30, ""), (72, " *"), (50, "//"), (64, "#")])
def test_wrapped_copies_of_all_templates(spark, classifier, width, mark):
    prose = [f"{mark} vuno karel {i} tivo" for i in range(40)]
    rows, want = [], {}
    for family, texts in licences.TEMPLATES.items():
        for i, text in enumerate(texts):
            lines = wrapped(text, width, mark)
            at = [0, 3, 37][len(rows) % 3]
            rows.append((len(rows), "\n".join([*prose[:at], mark, *lines, *([mark] if at else []), *prose[at:]])))
            want[len(rows) - 1] = (family, i, range(at + 1, at + 1 + len(lines)))
    got = [r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), classifier).collect() if r.confirmed]
    for doc, (family, i, lines) in want.items():
        mine = [r for r in got if r.doc_id == doc]
        assert mine and {r.family for r in mine} == {family}
        assert all(set(range(r.paragraph, r.paragraph + r.lines)) & set(lines) for r in mine)
    assert any(r.lines > 1 for r in got)


def test_a_wrapped_notice_is_one_row(spark, classifier):
    grant = licences.TEMPLATES["mit"][3]
    lines = wrapped(grant, 60, " *")
    texts = ["/*\n" + "\n".join(lines) + "\n */\nint main", "x\n\n" + "\n".join(lines) + "\n\n" + "\n".join(lines), "\n".join([*lines, "", "Released under the MIT License."]), grant]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph, r.lines, r.template, r.confirmed) for r in licences.scan(docs, classifier).collect())
    n = len(lines)
    assert [g for g in got if g[0] == 0] == [(0, 1, n, 3, True)] * 2  # once per row
    assert [g for g in got if g[0] == 1] == [(1, 2, n, 3, True), (1, 3 + n, n, 3, True)]
    assert [g for g in got if g[0] == 2] == [(2, 0, n, 3, True), (2, n + 1, 1, 0, True)]
    assert [g for g in got if g[0] == 3] == [(3, 0, 1, 3, True)]


def units_by_hand(text, step):
    out, run = [], []
    lines = ["".join(c if c.isascii() and c.isalnum() else " " for c in x.lower()).split() for x in text.split("\n")]
    for i, words in enumerate([*lines, []]):
        if words:
            out.append((None, i, i, words))
            run += [(i, w) for w in words]
        elif run:
            for at in range(0, max(1, len(run) - step), step):
                w = run[at : at + 2 * step]
                if w[0][0] < w[-1][0]:
                    out.append((run[0][0], w[0][0], w[-1][0], [x for _, x in w]))
            run = []
    return sorted(out, key=repr)


def test_units_by_hand(spark):
    rng = random.Random(4)
    texts = ["", "\n", "a", " \n\na b\n", "é\nA-b\r\n--\n7"] + ["".join(rng.choice("ab  \n\n.") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)] + [(-1, -1, None)], "doc_id long, row long, text string")
    got = licences.unit_rows(rows, 3).collect()
    for i, text in [*enumerate(texts), (-1, None)]:
        mine = sorted([(u.run, u.first, u.last, u.words) for u in got if u.doc_id == i], key=repr)
        assert mine == ([] if text is None else units_by_hand(text, 3)), text


def test_no_python_in_the_licence_scan(spark, classifier):
    plan = licences.scan(spark.read.parquet(f"{SMALL}/documents.parquet"), classifier)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
