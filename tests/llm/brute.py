"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def components(rows: list[tuple[int, str | None]], size: int = 2, percent: int = 80) -> dict[int, tuple[int, int, bool]]:
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    held: dict[tuple[str, ...], list[int]] = {}
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in held.get(s, ()))
        for s in sets[i]:
            held.setdefault(s, []).append(i)
        for j, k in common.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def lines(rows: list[tuple[int, str | None]], least: int = 24, edits: int = 2, least_copy: int | None = None) -> dict[int, tuple[list[int], int, int]]:
    """doc_id to (removed line numbers, near ones among first occurrences, links).

    Lines of ``least_copy`` characters (``least``, if not given) that are not blank go as copies, those of ``least`` also as near copies.
    """
    shortest = least if least_copy is None else least_copy
    places = [(i, k, line) for i, t in sorted(rows) for k, line in enumerate((t or "").split("\n")) if len(line) >= least or (len(line) >= shortest and line.strip("\t\v\f\r "))]
    first: dict[str, tuple[int, int]] = {}
    for i, k, line in places:
        first.setdefault(line, (i, k))
    by_length: dict[int, list[str]] = {}
    for line in first:
        if len(line) >= least:
            by_length.setdefault(len(line), []).append(line)
    links, near = Counter(), set()
    for a in (line for of_length in by_length.values() for line in of_length):
        for d in range(-edits, edits + 1):
            for b in by_length.get(len(a) + d, ()):
                if a != b and distance(a, b) <= edits:
                    links[a] += 1
                    if first[b] < first[a]:
                        near.add(a)
    out: dict[int, tuple[list[int], int, int]] = {i: ([], 0, 0) for i, _ in rows}
    for i, k, line in places:
        gone, n_near, n_links = out[i]
        is_first = first[line] == (i, k)
        out[i] = (gone + [k] * (line in near or not is_first), n_near + (line in near and is_first), n_links + links[line])
    return out


def without_repeats(rows: list[tuple[int | None, str | None]], length: int = 200) -> list[tuple]:
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def leaks(documents: list[tuple[int, str | None]], benchmark: list[tuple[int, str]], window: int = 8, coverage: float = 0.5) -> set[tuple[int, int]]:
    """Word windows without numbers and names."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    keys: dict[tuple[str, ...], set[tuple[int, int]]] = {}
    total = {}
    for i, t in benchmark:
        w = words(t)
        total[i] = len(w) - window + 1
        for k in range(total[i]):
            keys.setdefault(tuple(w[k : k + window]), set()).add((i, k))
    out = set()
    for d, t in documents:
        w, hit = words(t), {}
        for k in range(len(w) - window + 1):
            for i, at in keys.get(tuple(w[k : k + window]), ()):
                hit.setdefault(i, set()).add(at)
        out |= {(d, i) for i, at in hit.items() if len(at) >= coverage * total[i]}
    return out


def hard_negatives(rows: list[tuple], scale: int = 256) -> list[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) from rows (vec_id, label, vector)."""
    rows = [(i, [math.floor(scale * x) for x in v], label) for i, label, v in rows]
    out = []
    for anchor, a, label in rows:
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v, strict=False)), i, other) for i, v, other in rows if (i, v, other) != (anchor, a, label))
        for s, positive, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(anchor, positive, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fits)]
    return sorted(out)


def slipped_words(rows: list[tuple[int | None, str | None]], every: int = 97) -> Counter:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts: Counter = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(lower)
            if i is not None and (h := zlib.crc32(f"{i}:{w}".encode())) % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return counts


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, x in enumerate(a) if x != b[k]), len(a))
    return a[k:] == b[k + 1 :] if len(a) < len(b) else a[k + 1 :] == b[k + 1 :]


def spelling_groups(counts: dict[str, int], length: int = 5, least: int = 3, factor: int = 2) -> list[tuple]:
    """(word, form, root, n, n_near, form_n), each word against all others that share all but one letter."""
    n = {w: c for w, c in counts.items() if len(w) >= length and c >= least}
    holes: dict[tuple, set[str]] = {}
    for w in n:
        for k in range(len(w)):
            holes.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    near: dict[str, set[str]] = {w: set() for w in n}
    for (a, b), some in holes.items():
        some = some | ({a + b} & n.keys())
        for w in some:
            near[w] |= {x for x in some if one_edit(w, x)}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)
