"""Plain versions of the operators' definitions, for small fixtures."""

import re

UP = {i: i + 32 for i in range(65, 91)}


def words_nonspace(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))


def words_alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def shingles(text, k=5):
    w = words_nonspace(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def near_components(docs, percent=85):
    """docs: list of (doc_id, text) -> {doc_id: (n_shingles, component, kept)}"""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    byshingle = {}
    for d, s in sets.items():
        for x in s:
            byshingle.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in byshingle.values() for i, a in enumerate(ds) for b in ds[:i]}
    for a, b in pairs:
        i = len(sets[a] & sets[b])
        if 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def contamination(docs, items, k=13):
    """-> {doc_id: (n_words, n_hit, sorted item ids as strings)}"""
    windows = {}
    for i, t in items:
        w = words_alnum(t)
        n = min(k, len(w))
        for a in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[a:a + n]), set()).add(i)
    lengths = {len(x) for x in windows}
    out = {}
    for d, t in docs:
        w, hit, found = words_alnum(t), set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                got = windows.get(tuple(w[a:a + n]))
                if got:
                    hit.update(range(a, a + n))
                    found |= got
        out[d] = (len(w), len(hit), sorted(map(str, found)))
    return out


def line_dedup(docs, min_lines=3, long_words=20):
    """docs: list of (doc_id, text) in order -> {doc_id: kept text}: every run
    that also occurs earlier, tried at every place and length."""
    seqs = {d: [(i, x) for i, x in enumerate(t.split("\n")) if x.strip()] for d, t in docs}
    first = {}
    for d in sorted(seqs):
        s = seqs[d]
        for a in range(len(s)):
            for n in range(1, len(s) - a + 1):
                first.setdefault(tuple(x for _, x in s[a:a + n]), (d, a))
    out = {}
    for d, t in docs:
        s, gone = seqs[d], set()
        for a in range(len(s)):
            for n in range(1, len(s) - a + 1):
                run = tuple(x for _, x in s[a:a + n])
                if first[run] < (d, a) and (n >= min_lines or any(len(x.split()) >= long_words for x in run)):
                    gone |= {i for i, _ in s[a:a + n]}
        lines = t.split("\n")
        out[d] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out
