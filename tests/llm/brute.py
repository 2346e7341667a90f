"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def components(rows, k=4, percent=85):
    """{row number: (set size, smallest id linked)} of (id, text) rows; None ids never win unless alone."""
    sets = []
    for _, text in rows:
        w = words((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return [(d, len(s), min(ids[root(i)], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def repeats(rows, least):
    """(id, words, removed, kept) of (id, text) rows."""
    first = {}
    for d, text in rows:
        w = words(text)
        for i in range(len(w) - least + 1):
            key = tuple(w[i : i + least])
            if d is not None and (key not in first or d < first[key]):
                first[key] = d
    out = []
    for d, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - least + 1):
            if d is not None and first.get(tuple(w[i : i + least]), d) < d:
                gone |= set(range(i, i + least))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def _token(word):
    return word.lower().strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def tiles(item, text, least):
    """Greedy string tiling without any hashing: the longest match first, ties by place in the item, then in the text."""
    a, b, out = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and not a[p + n] and not b[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return out
        out.append((p, t, n))
        a[p : p + n] = [True] * n
        b[t : t + n] = [True] * n


def coverage(text, item, least=5):
    a, b = ([t for t in map(_token, words(x)) if t] for x in (item, text))
    seeds = {tuple(a[i : i + least]) for i in range(len(a) - least + 1)}
    if not any(tuple(b[i : i + least]) in seeds for i in range(len(b) - least + 1)):
        return 0.0
    return sum(n for _, _, n in tiles(a, b, least)) / len(a)


def quality(rows, texts, share, least_left):
    """(kept, cleaned text) of (text, host) rows."""
    norm = lambda line: " ".join(words(line)).lower()
    hosts = defaultdict(set)
    for text, host in rows:
        hosts[host].add(text or "")
    bad = set()
    for host, own in hosts.items():
        count = Counter(x for t in own for x in {norm(y) for y in t.split("\n") if words(y)})
        bad |= {(host, x) for x, n in count.items() if n >= texts and n >= share * len(own)}
    out = []
    for text, host in rows:
        w = words(text)
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        twice = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
        failed = len(w) < 10 or 100 * len(twice) > 20 * len(w)
        lines = (text or "").split("\n")
        stay = [x for x in lines if (host, norm(x)) not in bad]
        left = len(w) - sum(len(words(x)) for x in lines if (host, norm(x)) in bad)
        out.append((not failed and left >= least_left * len(w), None if text is None else "\n".join(stay)))
    return out
