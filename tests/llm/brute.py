"""Plain Python versions of the operators' contracts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def kept_words(docs, n=13):
    """``doc_id, n_words, n_removed, kept words`` of ``(doc_id, text)`` rows."""
    first = {}
    for doc_id, text in docs:
        w = words(text)
        if doc_id is not None:
            for k in range(len(w) - n + 1):
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        w, gone = words(text), set()
        for k in range(len(w) - n + 1 if doc_id is not None else 0):
            if first[tuple(w[k : k + n])] < doc_id:
                gone.update(range(k, k + n))
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, n=5):
    w = words(lower(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def near_classes(docs, percent=85):
    """Smallest linked id of each document, ids being distinct."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def statistics(text):
    """Words, their characters, symbols, repeated lines, words in repeated three-word windows."""
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


# Fixed patterns of the contract.
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def pii(text):
    found = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found
