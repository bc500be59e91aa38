"""Plain Python versions of the operators' contracts, for small tables."""

import collections
import hashlib
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def exact(rows):
    """(id, keep_id, group_size, sha256) of each (id, text); null ids are smallest."""
    groups = collections.defaultdict(list)
    for key, text in rows:
        groups[(text or "").translate(LOWER)].append(key)
    out = []
    for text, keys in groups.items():
        top = max((k for k in keys if k is not None), default=None)
        out += [(k, top, len(keys), hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str)


def repeats(rows, length=50):
    """(id, bytes, removed, spans, sha256 of the rest)."""
    rank = {key: -(1 << 70) if key is None else key for key, _ in rows}
    texts = [(key, (text or "").encode()) for key, text in rows]
    first = {}
    for key, data in texts:
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            first[part] = min(first.get(part, 1 << 70), rank[key])
    out = []
    for key, data in texts:
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < rank[key]:
                gone[at : at + length] = b"\1" * length
        rest = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def shingles(text, n=4):
    words = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def components(rows, percent=85):
    """(id, set size, smallest id of the component)."""
    sets = [(key, shingles(text)) for key, text in rows]
    distinct = list({s for _, s in sets if s})
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            b = distinct[j]
            if percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    number = {s: i for i, s in enumerate(distinct)}
    least = {}
    for key, own in sets:
        if own and key is not None:
            r = root(number[own])
            least[r] = min(key, least.get(r, key))
    return sorted(((k, len(s), least.get(root(number[s]), k) if s else k) for k, s in sets), key=str)


def contaminated(rows, items, length=13, share=20):
    """(id, words, hit words, items, sha256 of item ids, contaminated)."""
    windows = collections.defaultdict(set)
    for key, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        n = min(length, len(words))
        for at in range(len(words) - n + 1) if n else []:
            windows[tuple(words[at : at + n])].add("" if key is None else str(key))
    sizes = {len(w) for w in windows}
    out = []
    for key, text in rows:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(words) - n + 1):
                if (part := tuple(words[at : at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[part]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(found), digest, len(hit) > 0 and share * len(hit) >= len(words)))
    return sorted(out, key=str)


ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
    r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    """(assign, access, hex, sha256 of the base spans)."""
    text = text or ""
    spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    digest = hashlib.sha256(",".join(s[2] for s in sorted(spans)).encode()).hexdigest()
    return (*(sum(k == kind for _, k, _ in spans) for kind in range(3)), digest)


def runs(words, least=24, times=3):
    """(start, length, period) of every run, by start, then period: each period tried over all words."""
    best = {}
    for period in range(1, len(words) // times + 1):
        at = period
        while at < len(words):
            end = at
            while end < len(words) and words[end] == words[end - period]:
                end += 1
            if end > at and end - at + period >= max(least, times * period):
                best.setdefault((at - period, end), period)
            at = max(end, at + 1)
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def looped(words, number):
    """Words of a document that its source repeats."""
    n, g = len(words), number // 10
    if number % 10 or not n:
        return words
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    return [words[i if i < begin else begin + (i - begin) % period] for i in range(n)]


def collocations(rows, least=10, share=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (id, lang, text)."""
    counts, totals = collections.Counter(), collections.Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    phrases = {p: n for p, n in counts.items() if len(p) > 2 and n >= least}
    out = collections.defaultdict(list)
    for (lang, *words), a in phrases.items():
        longer = [n for (of, *more), n in phrases.items() if of == lang and len(more) > len(words) and tuple(words) in (tuple(more[:2]), tuple(more[1:]))]
        if any(100 * n >= share * a for n in longer):
            continue
        cuts = ((counts[(lang, *words[:k])], counts[(lang, *words[k:])], k) for k in range(1, len(words)))
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    ]
