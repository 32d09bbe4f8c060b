"""Small tables with awkward rows, and plain Python versions of the contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, row string, n_words long, ids string, spans string, text_key long"

PASSAGE = " ".join(f"w{k}" for k in range(30))


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en" if k % 3 else None, None, "x", 1, "y", None, 5) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [
    None, "", " \n\t ", "one", "two words", "A b C a B c a b c", PASSAGE, PASSAGE.upper(), f"before {PASSAGE} after", PASSAGE,
    "ñandú  日本 😀 \x00 ▁ end", "a " * 400, ("lorem ipsum dolor " * 3000), "x" * 9000, "x" * 9000,
    " ".join(f"u{k % 97}" for k in range(4000)), "line one\nline one\n\n \nline two\nline one",
]


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def reach(nodes, links):
    """Least node reachable from each node."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = re.findall(SPACE, fold(t))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    least = reach(sets, links)
    return {(i, len(s), least[i], i == least[i]) for i, s in sets.items()}


def repeats(docs, width=13):
    words = [(i, re.findall(SPACE, t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[k:k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


def contamination(docs, items, width=13):
    windows = defaultdict(set)
    for i, t in items:
        w = re.findall(ALNUM, fold(t))
        for k in range(max(1, len(w) - width + 1)):
            if w:
                windows[tuple(w[k:k + width])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = re.findall(ALNUM, fold(t)), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (key := tuple(w[k:k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[key]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def quality(text):
    text = text or ""
    w = re.findall(SPACE, text)
    times = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {j for k in range(len(w) - 2) if times[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def luhn(digits):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(digits))) % 10 == 0


def personal(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
