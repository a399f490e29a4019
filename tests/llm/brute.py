"""Plain versions of what the queries compute, one text or all pairs at a time."""

import re
import zlib
from collections import Counter

BLANK = r"[^\x20\x09-\x0D]+"
CAPITALS = {i: i + 32 for i in range(65, 91)}


def counts(text):
    words = re.findall(BLANK, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered, seen, repeated = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= set(range(i, i + 8))
    for line in text.split("\n"):
        if re.search(BLANK, line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def shingles(text, width):
    words = re.findall(BLANK, text.translate(CAPITALS))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def groups(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_texts(texts, width, percent=80):
    """component of each id of ``texts`` (id: text)."""
    sets = {i: shingles(t or "", width) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    links = []
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < i)
        links += [(i, j) for j, n in common.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    return groups(sets, links)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def private(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def secret(text):
    name = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(name, text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def licence(text):
    """(number of words, starts of base phrases, labels)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(CAPITALS))
    places, labels = [], set()
    for phrase, label in {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}.items():
        p = phrase.split()
        starts = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += starts
        labels |= {label} if starts else set()
    return len(words), sorted(places), sorted(labels)


def collocations(rows, min_count, top, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(CAPITALS)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    f[key] = f.get(key, 0) + 1
    out = {}
    long = {key: a for key, a in f.items() if a >= min_count and len(key[1]) > 1}
    for (lang, p), a in long.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(x == lang and len(q) > len(p) and 100 * b >= 100 * a and inside(q) for (x, q), b in long.items()):
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right, n))
    found = []
    for lang, rows_ in out.items():
        for rank, (score, a, p, left, right, n) in enumerate(sorted(rows_)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(found)


def variant_words(rows, min_count=3, shortest=5):
    """word -> n of (id, text) rows."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= shortest}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def variants(words):
    """(word, form, root, n, n_near, form_n) of word -> n."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)
