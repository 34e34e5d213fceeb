"""Plain versions of the operators for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, shingle=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, distance=2):
    """[(doc_id, fp)] to the smallest id of each row's component."""
    fps = sorted({fp for _, fp in rows})
    parent = {fp: fp for fp in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    low = {}
    for doc, fp in rows:
        root = find(fp)
        if doc is not None:
            low[root] = min(low.get(root, doc), doc)
    return [low.get(find(fp)) for _, fp in rows]


def repeats(texts, length=200):
    """Per text: (bytes, removed bytes, runs, digest of what is left)."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base_secrets(text):
    text, spans = text or "", []
    spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return host.translate(LOWER), path


def rule_of(host, path, rules):
    fits = [(len(h + p), h + p, kind) for kind, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def bench_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def contamination(docs, items, least=0.8, shingle=5):
    """{(doc, item): best weighted similarity of an item-sized window}."""
    def grams(words):
        return Counter(" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1))

    items = {k: w for k, t in items.items() if len(w := bench_words(t)) >= shingle}
    index = defaultdict(set)
    for k, w in items.items():
        for g in grams(w):
            index[g].add(k)
    out = {}
    for d, text in docs.items():
        words = bench_words(text)
        for k in {k for g in grams(words) for k in index.get(g, ())}:
            n, goal = len(items[k]), grams(items[k])
            for start in range(max(1, len(words) - n + 1)):
                here = grams(words[start:start + n])
                common = sum((here & goal).values())
                s = common / sum((here | goal).values())
                if s >= least and s > out.get((d, k), 0):
                    out[d, k] = s
    return out


def mix(rows, weights=(1, 2, 3), cap=3):
    """[(doc_id, text, source)] to [(doc, size, source size, target, taken)],
    resharing the excess round by round."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(size)
    while free:
        share = rest / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > cap * total[s]}
        if not over:
            target.update({s: share * weight[s] for s in free})
            break
        for s in over:
            target[s] = cap * total[s]
            rest -= target[s]
        free -= over
    out, at = {}, Counter()
    keyed = sorted(range(len(rows)), key=lambda i: (hashlib.md5(
        str("" if rows[i][0] is None else rows[i][0]).encode()).hexdigest(), size[i]))
    for i in keyed:
        s = rows[i][2]
        goal = int(target[s] + 1e-9)
        taken = sum(max(0, min(size[i], goal - k * total[s] - at[s])) for k in range(cap))
        at[s] += size[i]
        out[i] = (rows[i][0], size[i], total[s], target[s], taken)
    return [out[i] for i in range(len(rows))]
