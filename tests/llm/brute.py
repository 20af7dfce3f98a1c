"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

UP = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(UP))


def license_base(text):
    w = words(text)
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    hits = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def secrets(text):
    rules = (
        (re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
        (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24),
    )
    out = sorted((m.start(), k, m.end()) for k, (r, g, n) in enumerate(rules) for m in r.finditer(text or "") if len(m.group(g)) >= n)
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in out)
    return *(sum(o[1] == k for o in out) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard(rows, percent=90, n=3):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UP))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def contamination(text, items, n=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
    w, hit, ids = words(text), set(), set()
    for size in {len(k) for k in windows}:
        for a in range(len(w) - size + 1):
            if (k := tuple(w[a : a + size])) in windows:
                hit.update(range(a, a + size))
                ids |= windows[k]
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def repeats(rows, length):
    count = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raws:
        count.update(b[j : j + length] for j in range(len(b) - length + 1))
    out = []
    for i, b in raws:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if count[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for x in bytes(gone).split(b"\0") if x)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def passages(rows, words):
    """(id, maximal runs, bytes) of words under strings of so many words, A-Z lower-cased, that stand elsewhere too."""
    places = {n: [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for n, (_, t) in enumerate(rows)}
    low = {n: [(rows[n][1] or "").encode().lower()[a:b] for a, b in p] for n, p in places.items()}
    count = Counter(tuple(w[i : i + words]) for w in low.values() for i in range(len(w) - words + 1))
    out = []
    for n, w in low.items():
        gone = bytearray(len(w) + 1)
        for i in range(len(w) - words + 1):
            if count[tuple(w[i : i + words])] > 1:
                gone[i : i + words] = b"\1" * words
        runs = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((rows[n][0], len(runs), sum(places[n][b - 1][1] - places[n][a][0] for a, b in runs)))
    return out


def source_audit(rows, least=30, smooth=5, scale=10**9, top=50):
    """rows: (text, lang, source)."""
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    rows = [((t or "").translate(UP), lang or "", source or "") for t, lang, source in rows]
    docs = Counter((lang, w) for t, lang, _ in rows for w in set(term.findall(t)))
    kept = {k for k, n in docs.items() if n >= least}
    count = Counter((lang, s, w) for t, lang, s in rows for w in term.findall(t) if (lang, w) in kept)
    out = []
    for lang in {r[1] for r in rows}:
        terms = sorted(w for a, w in kept if a == lang)
        sources = sorted({r[2] for r in rows if r[1] == lang})
        share = lambda c, terms=terms: {w: 1 + scale * (c[w] + smooth) // (sum(c.values()) + smooth * len(terms)) for w in terms}
        by = {s: Counter({w: count[lang, s, w] for w in terms}) for s in sources}
        p, q = {s: share(c) for s, c in by.items()}, share(sum(by.values(), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in terms), o) for o in sources if o != s]
            used = [(p[s][w] - q[w], w) for w in terms if by[s][w] and p[s][w] > q[w]]
            for part, items in (("pair", pairs), ("term", used)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def personal(text):
    rules = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def good(kind, found):
        d = [int(c) for c in found if c in "0123456789"]
        if kind == 1:
            return all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in found.split("."))
        if kind == 2:
            return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0
        return kind == 0 or 9 <= len(d) <= 15

    return sorted((m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r, text or "") if good(k, m[0]))
