"""Centroid clustering, source mixing and conversation repair against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import AWKWARD, SPACE, documents, sha
from tidewatch.llm import clustering, mixing, queries, repair

# --- clustering ---------------------------------------------------------------------------------


def lloyd(rows, k=8, rounds=10, size=64, scale=1024, seed="3"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(col) // len(members[j]) for col in zip(*members[j])] if members[j] else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    own = Counter()
    for _, d, j in found:
        own[j] += d
    return sorted(((i, j, d, own[j], sum(own.values()), sha(",".join(map(str, centroids[j])))) for i, d, j in found), key=str)


def clustered(df, **more):
    out = clustering.cluster(df, **more).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", clustering.digest())
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_clusters_equal_plain_rounds(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(4)]) for i in range(60)]
    rows += [(None, [0.0] * 4), (None, [0.0] * 4), (7, rows[7][1]), (7, [9.0, 9.0, 9.0, 9.0]), (100, None), (101, []), (102, [1.0] * 5),
             (103, [1.0, None, 1.0, 1.0]), (104, [float("nan")] * 4), (105, [1.0, float("-inf"), 0.0, 0.0]), (106, [-1e-9] * 4)]
    rows += [(200 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)]  # a group of equal vectors
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v int").repartition(3)
    for k, rounds in ((8, 10), (3, 0), (5, 1), (500, 3)):
        assert clustered(df, size=4, k=k, rounds=rounds) == lloyd(rows, k, rounds, 4)


def test_clusters_of_nothing_and_of_far_components(spark):
    empty = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert clustered(empty) == []
    far = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        clustered(far, size=1)


# --- mixing -------------------------------------------------------------------------------------


def shares(sizes, weights=(3, 1, 2), percent=150, most=2):
    """Targets by plain resharing; ``sizes`` by source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    goal, free, rest = {}, set(names), percent / 100 * sum(sizes.values())
    while free:
        level = rest / sum(w[s] for s in free)
        above = {s for s in free if level * w[s] > most * sizes[s]}
        if not above:
            return goal | {s: level * w[s] for s in free}
        goal |= {s: float(most * sizes[s]) for s in above}
        rest -= sum(goal[s] for s in above)
        free -= above
    return goal


SOURCES = "doc_id long, text string, source string, row string, size int, key int"


def mixed(df, **more):
    return mixing.mix(df, **more).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    sources = ["b", "a", "", None, "ü", "z" * 50, "B"]
    rows = [(i, "w " * rng.choice([0, 1, 5, 9, 40]), rng.choice(sources + ["b"] * 7), "x", 1, 2) for i in range(900)]
    rows += [(5000 + i, "same text here", "b", "x", 1, 2) for i in range(400)] + [(1, None, None, "x", 1, 2)] * 3 + [(None, "a b", "a", "x", 1, 2)] * 30
    df = spark.createDataFrame(rows, SOURCES).repartition(5)
    got = mixed(df)
    sizes, taken, largest, n = Counter(), Counter(), Counter(), Counter()
    for _, text, source, *_ in rows:
        sizes[source] += len(re.findall(SPACE, text or ""))
    goal = shares(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        n[r.source] += r.copies
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 1.1 * largest[s] + 1
    count = Counter(r[2] for r in rows)
    for s in sizes:
        if sizes[s]:
            assert abs(n[s] - count[s] * goal[s] / sizes[s]) < 1.001
    assert sorted(map(str, got)) == sorted(map(str, mixed(df.repartition(2))))  # reruns and other layouts agree
    assert mixing.emitted(mixing.mix(df)).count() == sum(r.copies for r in got)


def test_mix_is_fair_over_seeds(spark):
    """Each document's mean copies over many offsets are its expected copies."""
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "ab"[i % 2], "", 0, 0) for i in range(40)], SOURCES)
    runs = [mixed(df, seed=str(s)) for s in range(6)]
    mean = sum(r.copies for run in runs for r in run) / len(runs)
    expected = sum(r.target / r.source_size for r in runs[0])
    assert abs(mean - expected) < 1


def test_mix_of_awkward_rows(spark):
    assert mixed(spark.createDataFrame([], SOURCES)) == []
    blank = mixed(spark.createDataFrame([(1, None, "a", "", 0, 0), (2, " \n", None, "", 0, 0)], SOURCES))
    assert {(r.size, r.source_size, r.target, r.copies) for r in blank} == {(0, 0, 0.0, 0)}
    docs = documents(spark, AWKWARD)
    sizes = {i: len(re.findall(SPACE, t or "")) for i, t in enumerate(AWKWARD)}
    got = mixing.mix(docs).select("row.doc_id", "size", "row.row", "copies").collect()
    assert {r.doc_id: r["size"] for r in got} == sizes and {r.row for r in got} == {"x"}


# --- conversations ------------------------------------------------------------------------------

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(faults, roles):
    """Least (cost, edits) by plain dynamic programming over row and last initial."""
    n = len(faults)
    after = {"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}
    for k in range(n - 1, -1, -1):
        now, late = {}, faults[k] == "truncated"
        for q in NEXT:
            ways = [(3 + after[q][0], "D" + after[q][1])]
            if faults[k] not in ("blank", "duplicate"):
                ways.append((2 + late + after[NEXT[q]][0], "R" + after[NEXT[q]][1]))
                initial = roles[k][:1]
                if initial == NEXT[q] or initial == "s" and q == "":
                    ways.append((late + after[initial][0], "K" + after[initial][1]))
            now[q] = min(ways)
        for _ in range(4):  # inserts before the row
            for q in NEXT:
                now[q] = min(now[q], (2 + now[NEXT[q]][0], "I" + now[NEXT[q]][1]))
        after = now
    return after[""]


def plain_repair(rows):
    space = lambda x: " " if x is None else x
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        group, kind = groups[conv], zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        group += [] if kind == 0 else [(turn, role, text)] * (1 + (kind == 3))
    out = []
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in group:
            words = re.findall(SPACE, text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1][-1] not in ".!?" else None)
            seen.add((role, text))
        roles, turns = [r for _, r, _ in group], [t for t, _, _ in group if t is not None]
        cost, edits = cheapest(faults, roles)
        lines, q, k = [], "", 0
        for e in edits:
            if e == "D":
                k += 1
                continue
            q = roles[k][:1] if e == "K" else NEXT[q]
            role = roles[k] if e == "K" else {"u": "user", "a": "assistant"}[q]
            lines.append(f"{role}:{'' if e == 'I' else group[k][2]}")
            k += e != "I"
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, sha("\n".join(lines))))
    return sorted(out, key=str)


ROWS = "conv_id long, turn long, role string, text string, key string, part int"


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(3)
    return sorted((tuple(r) for r in repair.report(repair.repair(df)).collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.text("suaxSUAX-", max_size=12))
def test_search_finds_the_least_cheapest_path(codes):
    faults = [{"-": "blank"}.get(c, "truncated" if c.isupper() else None) for c in codes]
    assert repair.search(codes) == cheapest(faults, [c.lower() for c in codes]) == repair.best_edits(codes)


@settings(max_examples=60, deadline=None)
@given(st.text("suaxUA-", min_size=65, max_size=300), st.integers(2, 64))
def test_parts_of_long_conversations_fold_to_the_same_path(codes, cut):
    faults = [{"-": "blank"}.get(c, "truncated" if c.isupper() else None) for c in codes]
    want = cheapest(faults, [c.lower() for c in codes])
    assert repair.best_edits(codes) == want
    ways = {repair.START: (0, 0, None)}
    for k in range(0, len(codes), cut):
        ways = repair.extend(ways, repair.part_steps(codes[k:k + cut]))
    cost, found = repair.finish(ways)
    assert (cost, "".join(e for _, e in found)) == want
    ways = repair.extend({repair.START: (0, 0, None)}, repair.part_steps(codes))  # one part of many rows
    assert repair.finish(ways)[0] == want[0] and repair.finish(ways)[1][0][1] == want[1]


def test_estimates_never_exceed_the_cost():
    rng = random.Random(1)
    for _ in range(500):
        codes = "".join(rng.choice("suaxSUAX-") for _ in range(rng.randrange(9)))
        for end in (None, 0, 1, 2, 3):
            bounds = repair._heuristic(codes, end)
            for k in range(len(codes) + (end is None)):
                for q in range(4):
                    way = repair.search(codes[k:], q, end)
                    assert way is None or bounds[k][q] <= way[0]


def test_conversations_equal_plain_repair(spark):
    rng = random.Random(9)
    words = ["hello there.", "is it?", "no end", "", " \n", "same.", "x" * 3000 + ".", "ñ😀 fin!"]
    rows = []
    for conv in range(80):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system"]) if conv % 3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn, role, f"{rng.choice(words)}" if conv % 2 else f"{turn} {conv} yes."))
    rows += [(900, None, None, None), (900, None, "user", "a."), (900, 3, "", "b."), (901, -70, "usher", "c"), (901, 70, "assistant", "c."),
             (None, 1, "user", "q?"), (None, None, "assistant", "r."), (902, 5, "user", "t."), (902, 5, "user", "t."), (902, 5, "assistant", "t.")]
    rows += [(903, t, ("user", "assistant")[t % 2], f"turn {t % 90}{'.' * (t % 5 > 0)}") for t in range(-300, 700)]  # many parts, repeats far apart
    rows += [(904, 7, ("user", "assistant")[k % 2], f"tie {k}.") for k in range(150)]  # many rows of one turn
    rows += [(905, 100 * t, "user", "one text.") for t in range(40)]
    assert repaired(spark, rows) == plain_repair(rows)
    assert repaired(spark, []) == []


def test_dropped_conversations_are_reported_as_empty(spark):
    gone = [(c, t) for c in range(200) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:4]
    assert repaired(spark, [(c, t, "user", "a.") for c, t in gone]) == sorted(
        ((c, 0, 0, 0, 0, 0, 0, "", sha("")) for c, _ in gone), key=str)


def test_conversation_query_on_the_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op13_conversation_repair"](spark, folder)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_repair(rows) and rows


def test_repaired_messages(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t} yes.") for t in range(100)]
    table = repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = [r.role for r in repair.messages(table).orderBy("part", "position").collect()]
    assert found and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(found)) and len(found) % 2 == 0
