"""Plain Python versions of the corpus operators, written from the contracts."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def space_words(text):
    return SPACE_WORD.findall(text or "")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


def fingerprint(text):
    w = space_words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints, radius=4):
    """For each place of the list, the place that stands for its linked group."""
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    a = np.array(prints, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= radius).tolist():
            up[root(j)] = root(i)
    return [root(i) for i in range(len(prints))]


def components(ids, prints, radius=4):
    """The smallest id linked to each place of the two lists."""
    roots, least = groups(prints, radius), {}
    for r, d in zip(roots, ids):
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return [least.get(r) for r in roots]


def base_spans(text):
    text, out = text or "", []
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    out += [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def line_dedup(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(d)
    last = {k: max((-1 << 70 if d is None else d) for d in v) for k, v in docs.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        mine = -1 << 70 if d is None else d
        kept = [x for x in lines if key(x) not in last or last[key(x)] == mine]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def contamination(rows, items, width=10):
    """(doc_id, n_words, n_hit, n_items, digest) of rows (doc_id, text)."""
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        span = min(width, len(w))
        for s in range(len(w) - span + 1 if w else 0):
            windows[tuple(w[s:s + span])].add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w, hit, found = item_words(t), set(), set()
        for span in {len(x) for x in windows}:
            for s in range(len(w) - span + 1):
                if ids := windows.get(tuple(w[s:s + span])):
                    hit.update(range(s, s + span))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def rule_counts(text):
    w = space_words(text)
    windows = list(zip(w, w[1:], w[2:]))
    n = Counter(windows)
    rep = {j for i, g in enumerate(windows) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep))


def lm_scores(rows, alpha=0.4, min_count=2, order=3):
    """(doc_id, n_words, mean log score) of rows (doc_id, text): the longest n-gram seen often enough, a factor a step."""
    docs = [(d, item_words(t)) for d, t in rows]
    counts = Counter(tuple(w[i:i + k]) for _, w in docs for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total, out = sum(len(w) for _, w in docs), []
    for d, w in docs:
        s = 0.0
        for i in range(len(w)):
            k = min(order, i + 1)
            while k > 1 and counts[tuple(w[i - k + 1:i + 1])] < min_count:
                s, k = s + np.log(alpha), k - 1
            s += np.log(counts[tuple(w[i - k + 1:i + 1])] / (counts[tuple(w[i - k + 1:i])] if k > 1 else total))
        out.append((d, len(w), round(s / len(w), 6) if w else None))
    return out


def mixture_targets(sizes, share=1.5):
    """source -> target from source -> words."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def token_index(rows, tokenizer):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text), null doc_ids last."""
    at, out = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def assign(lengths, size, linear, quadratic):
    """Packing by looking at every sequence for every rest."""
    out, rests = [], []
    for d, n in enumerate(lengths):
        out += [[(d, at, size)] for at in range(0, n // size * size, size)]
        rests += [(d, n // size * size, n % size)] if n % size else []
    total = sum(n for _, _, n in rests)
    rooms = [size] * (total // size) + [b for b in sorted((1 << k for k in range(size.bit_length())), reverse=True) if total % size & b]
    new, costs = [[] for _ in rooms], [0.0 for _ in rooms]
    while rests:
        d, at, n = min(rests, key=lambda r: (-r[2], r[0], r[1]))
        rests.remove((d, at, n))
        q = min((q for q, room in enumerate(rooms) if room >= n), key=lambda q: (costs[q], q), default=None)
        if q is None:
            q = min(range(len(rooms)), key=lambda q: (-rooms[q], costs[q], q))
            rests.append((d, at + rooms[q], n - rooms[q]))
            n = rooms[q]
        new[q].append((d, at, n))
        rooms[q] -= n
        costs[q] += linear * n + quadratic * n * n
    return out + new


def spelling(docs, lose_every=199, least=5, factor=5):
    """(word, n, n_near, form, form_n, root) from all neighbours of every word."""
    counts = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % lose_every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += len(w) >= 6
    n = {w: k for w, k in counts.items() if k >= least}
    letters, forms = sorted({x for w in n for x in w}), {}
    for w in n:
        around = {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in ["", *letters]}
        around |= {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
        near = [v for v in around - {w} if v in n]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        forms[w] = len(near), best if best and n[best] >= factor * n[w] else None
    out = []
    for w, (n_near, form) in forms.items():
        root = w
        while forms[root][1]:
            root = forms[root][1]
        out.append((w, n[w], n_near, form, n.get(form), root))
    return out


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(*values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _path(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 16 * 16
        out.append((nodes[first:i], nodes[i + 1:first + 16]))
        i //= 16
    return out


def merkle(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for d, source, lang, n, t in rows:
        own = _leaf(d, source, lang, n, t)
        hit = d is not None and zlib.crc32(str(d).encode()) % 5 == 0
        sources[source].append((d is None, d or 0, own, _leaf(d, source, lang, n, t and t.translate(LOWER)) if hit else own, d))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_tree([r[2] for r in sorted(sources[s])]) for s in names]
    top, out = _tree([t[-1][0] for t in trees]), []
    for k, s in enumerate(names):
        for i, (_, _, own, node, d) in enumerate(sorted(sources[s])):
            path = _path(trees[k], i) + _path(top, k)
            for left, right in path:
                node = _h(*left, node, *right)
            siblings = [x for left, right in path for x in left + right]
            out.append((d, own, trees[k][-1][0], top[-1][0], _h(*siblings), node, node == top[-1][0]))
    return out


def monotone(x, y, w):
    """Isotonic regression by its min-max formula: mean x and value of every flat block."""
    n, cw, cy = len(x), np.concatenate([[0], np.cumsum(w)]), np.concatenate([[0], np.cumsum(w * y)])
    values = np.empty(n)
    for i in range(n):
        a, b = np.arange(i + 1)[:, None], np.arange(i, n)[None, :]
        values[i] = ((cy[b + 1] - cy[a]) / (cw[b + 1] - cw[a])).min(axis=1).max()
    starts = [0, *(np.flatnonzero(np.diff(values) > 1e-9) + 1).tolist(), n]
    return (np.array([np.average(x[a:b], weights=w[a:b]) for a, b in zip(starts, starts[1:])]),
            np.array([values[a] for a in starts[:-1]]))


def quality_scores(docs, labels):
    """Scores of (doc_id, text) rows by least squares on all labelled rows outside the held-out third at once."""
    from parley.llm import quality as q
    f = np.array([np.float32(q.statistics(t)) for _, t in docs], dtype=float)
    at = {d: i for i, (d, _) in enumerate(docs)}
    used = [(d, y) for d, y in labels if y in (0, 1) and d in at and zlib.crc32(str(d).encode()) % 3 != 1]
    x, y = f[[at[d] for d, _ in used]], np.array([y for _, y in used], dtype=float)
    fold = np.array([xxhash.xxh64_intdigest(struct.pack("<q", d), 42) % 2 for d, _ in used])
    mean, scale, penalty = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), max(1e-2, q.RIDGE * len(y))
    rng = np.random.default_rng(q.SEED)
    w, b = rng.normal(0, 1 / q.WIDTH, (f.shape[1], q.DIM)), rng.uniform(0, 2 * np.pi, q.DIM)

    def lift(rows):
        return np.hstack([np.sqrt(2 / q.DIM) * np.cos(np.clip((rows - mean) / scale, -6, 6) @ w + b), np.ones((len(rows), 1))])

    def ridge(z, y):
        return np.linalg.lstsq(np.vstack([z, np.sqrt(penalty) * np.eye(z.shape[1])]), np.append(y, np.zeros(z.shape[1])))[0]

    z = lift(x)
    raw = np.where(fold == 0, z @ ridge(z[fold == 1], y[fold == 1]), z @ ridge(z[fold == 0], y[fold == 0]))
    bins, place, size = np.unique(np.round(np.clip(raw, -0.5, 1.5) * q.BINS / 2), return_inverse=True, return_counts=True)
    knots, values = monotone(bins / q.BINS * 2, np.bincount(place, y) / size, size.astype(float))
    raw = lift(f) @ ridge(z, y)
    return (np.interp(raw, knots, values) + 1e-3 * np.clip(raw, 0, 1)) / (1 + 1e-3)
