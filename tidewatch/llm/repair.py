"""Repair of conversation structure by iterative-deepening A*.

A conversation is damaged by a hash of its rows, then repaired: the cheapest edits (Delete 3, Insert 2, Keep 0, Rerole 2, a
kept or reroled truncated row 1 more) after which the initials of the roles match ``(s?(ua)+)?``. The search goes depth-first over
(row, state of the pattern) and tries edits in ASCII order under a cost bound that grows by one; a table keeps, for each such
pair, the largest rest of a bound that is known to fail. The first accepting path is then the cheapest, and of
equally cheap ones the least. The bound starts at an admissible estimate: 3 for each row that must go, 2 for each role that
cannot stay, 1 for each truncated row and for each two neighbours of one role (an edit of cost 2 mends two of them at most).

Rows are grouped by conversation and 64 consecutive turn numbers, so no task holds a whole long conversation. One that lies in
a single part, as almost all do, is searched and written in one step. For a longer one each part (cut further where turns
repeat) is searched once for each state it can begin and end in; a small fold over (cost, edits) of the parts gives the same answer, since
audits of one part that differ are never each other's beginning. Its text is hashed as a stream of parts in order.

Defined results: nulls of any column count as one space; the id stays as it is, a null id being one conversation. Rows
of one turn follow role and text in code point order, null turns come first. Repeated rows are duplicates. An initial other than s, u or a
(or an empty role) must be reroled or deleted. Texts and conversations may be of any length; an empty table gives an empty table.
Only the four columns are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import materialise

START, SYSTEM, USER, ASSISTANT = range(4)  # nothing, or the last role written
INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DELETES, INSERTS, REROLES = 3, 2, 2
TURNS = 64  # turn numbers of a part
LONG = 64  # rows searched at once

# A row's code is its initial (``x`` for any but s, u and a), in upper case if it is truncated, or ``-`` if it must go.
SPACE = " \t\n\v\f\r"
NO_TURN = -(1 << 62)  # part of null turns, before all others


def _heuristic(codes: str, end: int | None) -> list[tuple[int, int, int, int]]:
    """For each row, and the end, a lower bound of the cost from each state on."""
    ahead = {None: "u", ASSISTANT: "u", USER: "a"}.get(end, "")  # a virtual role behind the last row
    cost, systems, out = 0, 0, []

    def bounds() -> tuple[int, int, int, int]:
        after_assistant, after_user = cost + (ahead == "a"), cost + (ahead == "u")
        return after_assistant - 2 * (systems > 0), after_assistant, after_user, after_assistant

    out.append(bounds())
    for code in reversed(codes):
        if code == "-":
            cost += DELETES
        else:
            role = code.lower()
            cost += code.isupper()
            if role in "ua":
                cost += role == ahead
                ahead = role
            else:
                cost += 2
                systems += role == "s"
                ahead = ""
        out.append(bounds())
    return out[::-1]


def search(codes: str, start: int = START, end: int | None = None) -> tuple[int, str] | None:
    """Cost and edits of the least of the cheapest paths over ``codes`` from state ``start``.

    With ``end`` None the path accepts, else it reaches that state right after the last row; None if none does.
    """
    if end in (START, SYSTEM) and not (start == end or start == START and "s" in codes.lower()):
        return None  # a system row is only ever kept
    n, bound_of = len(codes), _heuristic(codes, end)
    failed: dict[tuple[int, int], int] = {}
    goal = (START, ASSISTANT) if end is None else (end,)

    def deepen(i: int, q: int, rest: int) -> str | None:
        if rest < bound_of[i][q] or failed.get((i, q), -1) >= rest:
            return None
        if i == n and q in goal:
            return ""
        if i < n:
            code = codes[i]
            found = deepen(i + 1, q, rest - DELETES)
            if found is not None:
                return "D" + found
        if i < n or end is None:
            found = deepen(i, INSERT[q], rest - INSERTS)
            if found is not None:
                return "I" + found
        if i < n and code != "-":
            late = code.isupper()
            to = KEEP.get((q, code.lower()))
            if to is not None:
                found = deepen(i + 1, to, rest - late)
                if found is not None:
                    return "K" + found
            found = deepen(i + 1, INSERT[q], rest - REROLES - late)
            if found is not None:
                return "R" + found
        failed[i, q] = rest
        return None

    most = 3 * n + 6  # deleting all rows, or changing each role, and inserts: no cheapest path costs more
    for bound in range(bound_of[0][start], most + 1):
        path = deepen(0, start, bound)
        if path is not None:
            return bound, path
    return None


@lru_cache(maxsize=1 << 16)
def steps(codes: str) -> list[tuple[int, int, int, str]]:
    """``start, end, cost, edits`` of at most ``LONG`` rows, for each pair of states that a path joins."""
    found = ((a, b, search(codes, a, b)) for a in range(4) for b in range(4))
    return [(a, b, *way) for a, b, way in found if way]


def extend(ways: dict, part: list[tuple[int, int, int, str]]) -> dict:
    """Best way to each state after one more part; a way is (cost, rank of its edits, link to the edits so far).

    Ways of one length in rows are never each other's beginning, so a rank and the edits of the part order them.
    """
    best: dict = {}
    for start, end, cost, edits in part:
        if start in ways:
            so_far, rank, link = ways[start]
            way = (so_far + cost, rank, edits, start, link)
            if end not in best or way[:3] < best[end][:3]:
                best[end] = way
    ranked = sorted(best, key=lambda q: best[q][1:3])
    return {q: (best[q][0], ranked.index(q), (best[q][4], best[q][3], best[q][2])) for q in best}


def finish(ways: dict) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the best accepting way, and state and edits of each part; the last takes the inserts at the end."""
    tail = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    cost, _, q = min((cost + INSERTS * len(tail[q]), rank, q) for q, (cost, rank, _) in ways.items())
    link, out = ways[q][2], []
    while link:
        link, start, edits = link
        out.append((start, edits))
    out.reverse()
    if out:
        out[-1] = (out[-1][0], out[-1][1] + tail[q])
    return cost, out


def _pieces(codes: str) -> Iterator[str]:
    return (codes[k:k + LONG] for k in range(0, len(codes), LONG))


def part_steps(codes: str) -> list[tuple[int, int, int, str]]:
    """``steps`` of a part of any length."""
    if len(codes) <= LONG:
        return steps(codes)
    out = []
    for start in range(4):
        ways = {start: (0, 0, None)}
        for piece in _pieces(codes):
            ways = extend(ways, steps(piece))
        for end, (cost, _, link) in ways.items():
            edits = []
            while link:
                link, _, some = link
                edits.append(some)
            out.append((start, end, cost, "".join(reversed(edits))))
    return out


@lru_cache(maxsize=1 << 16)
def best_edits(codes: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    if len(codes) <= LONG:
        return search(codes)
    ways = {START: (0, 0, None)}
    for piece in _pieces(codes):
        ways = extend(ways, steps(piece))
    cost, found = finish(ways)
    return cost, "".join(edits for _, edits in found)


def digest(role: str, text: str) -> str:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def codes_of(roles: list[str], texts: list[str], seen: list[str] | None) -> tuple[str, int, int, int]:
    """Codes of a part's rows, and how many are blank, duplicate and truncated; ``seen`` digests are of earlier parts."""
    earlier, had, codes, counts = set(seen or ()), set(), [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        content = text.rstrip(SPACE)
        if not content:
            fault = 0
        elif (role, text) in had or earlier and digest(role, text) in earlier:
            fault = 1
        else:
            fault = 2 if content[-1] not in ".!?" else None
        had.add((role, text))
        if fault is not None:
            counts[fault] += 1
        code = role[:1] if role[:1] in ("s", "u", "a") else "x"
        codes.append("-" if fault in (0, 1) else code.upper() if fault == 2 else code)
    return "".join(codes), *counts


def apply_edits(edits: str, start: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts that the edits leave."""
    q, i, out = start, 0, ([], [])
    for edit in edits:
        if edit == "D":
            i += 1
            continue
        q = KEEP[q, roles[i][:1]] if edit == "K" else INSERT[q]
        out[0].append(roles[i] if edit == "K" else "user" if q == USER else "assistant")
        out[1].append("" if edit == "I" else texts[i])
        i += edit != "I"
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn`` and ``left``, the 0 to 2 rows (role, text) that the damage leaves of each."""
    spaced = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(name.cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    row = F.struct("turn", role.alias("role"), text.alias("text"))
    left = F.when(kind == 0, F.array().cast("array<struct<turn:bigint,role:string,text:string>>")).when(kind == 3, F.array(row, row)).otherwise(F.array(row))
    return spaced.select("conv_id", "turn", left.alias("left"))


def parts(damage: DataFrame) -> DataFrame:
    """``key, conv_id, part, rows``: the rows in order of each conversation and run of ``TURNS`` turn numbers."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    part = F.coalesce(F.shiftright("turn", TURNS.bit_length() - 1), F.lit(NO_TURN))
    return damage.groupBy(key.alias("key"), "conv_id", part.alias("part")).agg(
        F.sort_array(F.flatten(F.collect_list("left"))).alias("rows"))


def seen_before(long: DataFrame) -> DataFrame:
    """Adds ``seen``: digests of a part's rows that an earlier part of the conversation has too."""
    mark = F.transform("rows", lambda r: F.md5(F.concat(F.length(r["role"]).cast("string"), F.lit(":"), r["role"], r["text"])))
    marks = materialise(long.select("key", "part", F.explode(F.array_distinct(mark)).alias("mark")), "marks")
    first = marks.groupBy("key", "mark").agg(F.min("part").alias("first"))
    again = marks.join(first, ["key", "mark"]).where("part > first").groupBy("key", "part").agg(F.collect_list("mark").alias("seen"))
    return long.join(again, ["key", "part"], "left")


_OUT = ("repaired array<struct<role:string,text:string>>, audit string, cost long, blank long, duplicate long, truncated long, "
        "illegal long, first string, last string, low long, high long, turns long")


def _lists(column: pa.ListArray) -> Iterator[tuple[list, list[str], list[str]]]:
    """Turns, roles and texts of each part."""
    turns, roles, texts = (c.to_pylist() for c in column.flatten().flatten())
    ends = column.offsets.to_pylist()
    for a, b in zip((e - ends[0] for e in ends[:-1]), (e - ends[0] for e in ends[1:]), strict=True):
        yield turns[a:b], roles[a:b], texts[a:b]


def _is_illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with their edits made; a part without given edits is a whole conversation and is searched here."""
    for batch in batches:
        n = batch.num_rows
        given = zip(*(batch[c].to_pylist() for c in ("seen", "start", "edits"))) if "edits" in batch.schema.names else [(None, START, None)] * n
        written, ends, out = ([], []), [0], {c: [] for c in ("audit", "cost", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")}
        for (turns, roles, texts), (seen, start, edits) in zip(_lists(batch["rows"]), given, strict=True):
            codes, blank, duplicate, truncated = codes_of(roles, texts, seen)
            edits = best_edits(codes)[1] if edits is None else edits
            for column, more in zip(written, apply_edits(edits, start, roles, texts), strict=True):
                column += more
            ends.append(len(written[0]))
            kept = codes_kept(edits, codes)
            cost = DELETES * edits.count("D") + INSERTS * edits.count("I") + REROLES * edits.count("R") + kept
            initials, numbers = [r[:1] for r in roles], [t for t in turns if t is not None]
            values = (edits, cost, blank, duplicate, truncated, sum(map(_is_illegal, initials, initials[1:])), initials[0] if roles else None,
                      initials[-1] if roles else None, min(numbers, default=None), max(numbers, default=None), len(set(numbers)))
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
        pairs = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in written], names=["role", "text"])
        text = ("audit", "first", "last")
        yield pa.RecordBatch.from_pydict(
            {c: batch[c] for c in ("key", "conv_id", "part")}
            | {"repaired": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)}
            | {c: pa.array(v, pa.string() if c in text else pa.int64()) for c, v in out.items()})


def codes_kept(edits: str, codes: str) -> int:
    """Truncated rows among those that the edits leave."""
    return sum(code.isupper() and edit != "D" for code, edit in zip(codes, edits.replace("I", ""), strict=True))


def _stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The search of each part of a long conversation, from and to all states."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
    for batch in batches:
        found = [[dict(zip(("start", "end", "cost", "edits"), step, strict=True)) for step in part_steps(codes_of(roles, texts, seen)[0])]
                 for (_, roles, texts), seen in zip(_lists(batch["rows"]), batch["seen"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"key": batch["key"], "part": batch["part"], "steps": pa.array(found, kind)})


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State and edits of each part, from parts in order."""
    key, numbers, ways = None, [], {}

    def done() -> pa.RecordBatch:
        _, found = finish(ways)
        return pa.RecordBatch.from_pydict({
            "key": pa.array([key] * len(numbers), pa.string()), "part": pa.array(numbers, pa.int64()),
            "start": pa.array([s for s, _ in found], pa.int32()), "edits": pa.array([e for _, e in found], pa.string())})

    for batch in batches:
        for name, part, found in zip(*(batch[c].to_pylist() for c in ("key", "part", "steps")), strict=True):
            if name != key:
                if numbers:
                    yield done()
                key, numbers, ways = name, [], {START: (0, 0, None)}
            numbers.append(part)
            ways = extend(ways, [(s["start"], s["end"], s["cost"], s["edits"]) for s in found])
    if numbers:
        yield done()


def repair(rows: DataFrame) -> DataFrame:
    """The damaged rows repaired, a row for each part of a conversation: ``repaired`` (role, text), the edits, what was wrong."""
    cut = materialise(parts(damaged(rows)), "parts")
    several = materialise(cut.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "several")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"key string, conv_id {id_type}, part long, {_OUT}"
    whole = cut.join(several, "key", "left_anti").mapInArrow(_edited, schema).withColumn("is_whole", F.lit(True))
    long = seen_before(cut.join(several, "key", "left_semi"))
    found = long.mapInArrow(_stepped, "key string, part long, steps array<struct<start:int,end:int,cost:long,edits:string>>")
    edits = _in_order(found).mapInArrow(_folded, "key string, part long, start int, edits string")
    return whole.unionAll(long.join(edits, ["key", "part"]).mapInArrow(_edited, schema).withColumn("is_whole", F.lit(False)))


def _in_order(table: DataFrame) -> DataFrame:
    """The parts of a conversation one after the other in one partition, read as a stream."""
    return table.repartition("key").sortWithinPartitions("key", "part")


def messages(repaired: DataFrame) -> DataFrame:
    """``conv_id, part, position, role, text`` of the repaired rows."""
    return repaired.select("conv_id", "part", F.posexplode("repaired").alias("position", "row")).select("conv_id", "part", "position", "row.*")


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _totalled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each long conversation, from its parts in order; the text goes through the hash as it comes."""
    key, total = None, {}

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "conv_id": total["conv_id"], **{c: pa.array([total[c]], pa.int64()) for c in _REPORT},
            "audit": ["".join(total["audit"])], "repaired_sha256": [total["hash"].hexdigest()]})

    for batch in batches:
        rest = {c: batch[c].to_pylist() for c in batch.schema.names if c not in ("repaired", "conv_id")}
        pairs = _pairs(batch["repaired"])
        for k, (roles, texts) in enumerate(pairs):
            if rest["key"][k] != key:
                if key is not None:
                    yield done()
                key = rest["key"][k]
                total = dict.fromkeys(_REPORT, 0) | {"conv_id": batch["conv_id"].slice(k, 1), "audit": [], "hash": hashlib.sha256(),
                                                     "last": None, "low": None, "high": None, "turns": 0, "any": False}
            for c in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                total[c] += rest[c][k]
            if rest["first"][k] is not None:
                total["illegal"] += total["last"] is not None and _is_illegal(total["last"], rest["first"][k])
                total["last"] = rest["last"][k]
            if rest["low"][k] is not None:
                total["low"] = min(rest["low"][k], rest["low"][k] if total["low"] is None else total["low"])
                total["high"] = max(rest["high"][k], rest["high"][k] if total["high"] is None else total["high"])
                total["gaps"] = total["high"] - total["low"] + 1 - total["turns"]
            total["audit"].append(rest["audit"][k])
            for role, text in zip(roles, texts, strict=True):
                total["hash"].update(f"{chr(10) if total['any'] else ''}{role}:{text}".encode())
                total["any"] = True
    if key is not None:
        yield done()


def _pairs(column: pa.ListArray) -> Iterator[tuple[list[str], list[str]]]:
    roles, texts = (c.to_pylist() for c in column.flatten().flatten())
    ends = column.offsets.to_pylist()
    return ((roles[a - ends[0]:b - ends[0]], texts[a - ends[0]:b - ends[0]]) for a, b in zip(ends[:-1], ends[1:], strict=True))


def report(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: gaps, faults, cost, edits, and the SHA-256 of the repaired text."""
    whole = repaired.where("is_whole")
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    own = whole.select("conv_id", gaps.alias("gaps"), *_REPORT[1:], "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    id_type = repaired.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, {', '.join(f'{c} long' for c in _REPORT)}, audit string, repaired_sha256 string"
    return own.unionAll(_in_order(repaired.where("not is_whole").drop("is_whole")).mapInArrow(_totalled, schema))
