"""Plain answers to the corpus queries, written from their definitions."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def order(key):
    """Null ids are larger than all others."""
    return (key is None, key if key is not None else 0)


def words(text):
    return WORD.findall((text or "").encode())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def token_files(docs, encode, end):
    out, start = [], 0
    for key, text in sorted(docs, key=lambda d: order(d[0])):
        ids = [*encode(text or ""), end]
        out.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = [x.decode() for x in words(text)]
    lines = [x for x in (text or "").split("\n") if WORD.search(x.encode())]
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (
        len(w),
        sum(map(len, w)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def substring(docs, window=13):
    split = [(order(key), key, words(text)) for key, text in docs]
    first = {}
    for o, _, w in split:
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, o), o)
    out = []
    for o, key, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < o:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text):
    w = words((text or "").encode().lower().decode())
    if not w:
        return 0
    n = min(3, len(w))
    runs = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def components(count, linked, names):
    """Smallest name reachable from every position."""
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    least = {}
    for i in range(count):
        r = find(i)
        least[r] = min(least.get(r, names[i]), names[i], key=order)
    return [least[find(i)] for i in range(count)]


def simhash(docs):
    fps = [fingerprint(text) for _, text in docs]
    a = np.array(fps, np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    found = components(
        len(docs), np.argwhere(np.triu(near, 1)).tolist(), [k for k, _ in docs]
    )
    return [
        (key, f"{fp:016x}", c)
        for (key, _), fp, c in zip(docs, fps, found, strict=True)
    ]


def normal(line):
    return " ".join(line.lower().split())


def every_line(docs, shingle=8, threshold=0.8):
    """(id, numbers of the lines that stay) with lines of any length; distinct ids."""
    places = sorted(
        (order(key), i, normal(x))
        for key, text in docs
        for i, x in enumerate((text or "").split("\n"))
        if normal(x)
    )
    different = sorted({x for _, _, x in places})
    sets = [
        {x[i : i + shingle] for i in range(max(1, len(x) - shingle + 1))}
        for x in different
    ]
    links = [
        (i, j)
        for i, a in enumerate(sets)
        for j, b in enumerate(sets[:i])
        if len(a & b) >= threshold * len(a | b)
    ]
    group = components(len(different), links, list(range(len(different))))
    group = dict(zip(different, group, strict=True))
    taken, gone = set(), set()
    for o, i, x in places:
        if group[x] in taken:
            gone.add((o, i))
        taken.add(group[x])
    return [
        (key, [i for i in range(len((text or "").split("\n"))) if (order(key), i) not in gone])
        for key, text in docs
    ]


def embeddings(rows, cosine=0.98):
    """(id, vector, label) -> (id, n_links, component_id, kept)."""

    def usable(v, label):
        return (
            label is not None
            and v is not None
            and len(v) > 0
            and all(x is not None and np.isfinite(x) for x in v)
            and any(v)
        )

    links = []
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            _, u, other = rows[j]
            if label == other and usable(v, label) and usable(u, other):
                if len(u) == len(v):
                    a, b = np.array(v, float), np.array(u, float)
                    a, b = a / np.abs(a).max(), b / np.abs(b).max()
                    if a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                        links.append((i, j))
    names = [k for k, _, _ in rows]
    degree = collections.Counter(i for pair in links for i in pair)
    found = components(len(rows), links, names)
    return [(k, degree[i], c, k == c) for i, (k, c) in enumerate(zip(names, found))]


def ball_kmeans(rows, parts, entries, rounds):
    """(id, vector, label) -> ((id, code, error, label_error), sha256 of the codebooks)."""
    kept = sorted(
        (
            (order(key), [math.floor(4096 * x) for x in v], key, label)
            for key, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)
        ),
        key=lambda r: r[:2],
    )
    size = len(kept[0][1])
    bounds = [size * i // parts for i in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(bounds, bounds[1:])] for _, v, _, _ in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [
            [min((apart(v[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)]
            for v in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [v[p] for v, f in zip(cut, found) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(x) // len(own) for x in zip(*own)]
    errors = [(sum(d for d, _ in f), "".join(f"{i:02x}" for _, i in f)) for f in assign()]
    by_label = collections.Counter()
    for (_, _, _, label), (error, _) in zip(kept, errors):
        by_label[label] += error
    text = ",".join(str(x) for book in books for e in book for x in e)
    out = [
        (key, code, error, by_label[label])
        for (_, _, key, label), (error, code) in zip(kept, errors)
    ]
    return out, hashlib.sha256(text.encode()).hexdigest()


def _xlogx(x):
    return x * math.log(max(x, 1))


def class_ngrams(docs, k, rounds, discount=0.5, prior=1.0):
    """(id, text) -> (id, held_out, n_tokens, n_known, train_tokens, base, score)."""

    def tokens(text):
        return [w.lower() for w in words(text)] + [b""]

    def held(key):
        return key is not None and zlib.crc32(str(key).encode()) % 7 == 2

    train = [tokens(t) for key, t in docs if not held(key)]
    count = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(
        pair for t in train for pair in zip([b""] + t, t)
    )
    salt = {w: xxhash.xxh64_intdigest(w) & 0xFFFF for w in count}
    cls = {w: salt[w] % k for w in count}
    for rank, w in enumerate(sorted(count, key=lambda w: (-count[w], w))[:k]):
        cls[w] = rank

    def matrix():
        n = [[0] * k for _ in range(k)]
        for (a, b), c in pairs.items():
            n[cls[a]][cls[b]] += c
        return n

    for turn in range(rounds):
        n = matrix()
        left = [sum(r) for r in n]
        right = [sum(r[c] for r in n) for c in range(k)]
        moved = dict(cls)
        for w in count:
            if (salt[w] >> 15) != turn % 2:
                continue
            after, before = [0] * k, [0] * k
            for (a, b), c in pairs.items():
                if a == w:
                    after[cls[b]] += c
                if b == w:
                    before[cls[a]] += c
            a = cls[w]

            def change(b, sign):
                def cell(x, by):
                    return _xlogx(max(x + sign * by, 0)) - _xlogx(x)

                return (
                    sum(cell(n[b][c], after[c]) + cell(n[c][b], before[c]) for c in range(k))
                    - cell(left[b], sum(after))
                    - cell(right[b], sum(before))
                )

            gains = [1e-9 if b == a else change(b, 1) + change(a, -1) for b in range(k)]
            moved[w] = max(range(k), key=lambda b: (gains[b], -b))
        cls = moved
    n = matrix()
    total, types = sum(count.values()), len(count)
    of_class = [sum(c for w, c in count.items() if cls[w] == i) for i in range(k)]
    in_class = [sum(1 for w in count if cls[w] == i) for i in range(k)]

    def step(row):
        return [
            (row[c] + prior * of_class[c] / total) / (sum(row) + prior) for c in range(k)
        ]

    out = []
    steps = [step(row) for row in n] if total else []
    unseen = [sum(in_class[a] / types * steps[a][c] for a in range(k)) for c in range(k)] if total else []
    for key, text in docs:
        t = tokens(text)
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in t)
        score, last = 0.0, steps[cls[b""]] if total else None
        for w in t if total else []:
            if w in count:
                c = cls[w]
                score += math.log10(last[c] * (count[w] - discount) / of_class[c])
                last = steps[c]
            else:
                score += math.log10(
                    sum(last[c] * discount * in_class[c] / max(of_class[c], 1) for c in range(k))
                )
                last = unseen
        out.append(
            (key, held(key), len(t), sum(w in count for w in t), total, base, score)
        )
    return out


def filter_audit(docs, labels):
    """(id, text, lang) rows, (id, quality, toxic) rows -> rows of the audit."""
    first = {}
    for key, text, _ in docs:
        t = text or ""
        first[t] = min(first.get(t, order(key)), order(key))
    good = {key for key, q, _ in labels if q == 1 and key is not None}
    toxic = {key for key, _, x in labels if x == 1 and key is not None}
    by_part = collections.defaultdict(list)
    for key, text, lang in docs:
        t = text or ""
        w = words(t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": order(key) > first[t],
        }
        by_part[lang or ""].append((key, fails))
    out = []
    for part, rows in by_part.items():
        shapley, steps = collections.Counter(), []
        for names in itertools.permutations("ABCDE"):
            left = rows
            for at, name in enumerate(names, 1):
                gone = [r for r in left if r[1][name]]
                left = [r for r in left if not r[1][name]]
                shapley[name] += len(gone)
                failing = sum(f[name] for _, f in rows)
                alone = sum(f[name] and sum(f.values()) == 1 for _, f in rows)
                steps.append(
                    (
                        "".join(names), at, len(left), len(gone), failing - len(gone), alone,
                        sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone), name,
                    )
                )
        out += [(part, *row[:-1], shapley[row[-1]]) for row in steps]
    return out
