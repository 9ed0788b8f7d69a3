"""The operators once more in plain Python, over all rows and all pairs; hashes of ids that Spark makes are given."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

from ledgerloom.llm import decontamination, quality, secrets, toxicity
from ledgerloom.llm.words import EDGES

M = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C15


def mix_bits(x):
    x = (x ^ x >> 31) * 0x7FB5D329728EA185 & M
    return x ^ x >> 29


def gram(words, steps):
    out = []
    for i in range(len(words) - sum(steps)):
        value, at = words[i], i
        for s in steps:
            at += s
            value = mix_bits(value * ODD + words[at] & M)
        out.append(value)
    return out


# Toxicity


def toxic_features(text):
    words = [xxhash.xxh64_intdigest(w.strip(EDGES).lower()) for w in text.split()]
    found = [w * ODD & M for w in words]
    for steps in ((1,), (1, 1), (2,), (3,)):
        found += gram([w + sum(steps) * 8 + len(steps) & M for w in words], steps)
    return {x >> 64 - toxicity.BITS for x in found}


def toxicity_scores(texts, examples):
    """Scores of the texts by a model that saw the (text, label) examples in their order."""
    z, n, bias = {}, {}, "bias"
    sig = lambda x: 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))

    def weight(f):
        own = z.get(f, 0.0)
        if abs(own) <= toxicity.L1:
            return 0.0
        return -(own - math.copysign(toxicity.L1, own)) / ((toxicity.BETA + math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA + toxicity.L2)

    prepared = [([*sorted(toxic_features(t)), bias], y) for t, y in examples]
    for _ in range(toxicity.EPOCHS):
        for features, label in prepared:
            weights = [weight(f) for f in features]
            g = (sig(sum(weights)) - label) * (toxicity.POSITIVE if label else 1.0)
            for f, w in zip(features, weights):
                old = n.get(f, 0.0)
                n[f] = old + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(old)) / toxicity.ALPHA * w
    return [sig(weight(bias) + sum(weight(f) for f in toxic_features(t))) for t in texts]


# Quality


def quality_buckets(text):
    tokens = []
    for t in text.split():
        marks = "".join(re.findall(r"[^\w\s]+", t))
        core = xxhash.xxh64_intdigest(re.sub(r"[^\w\s]+", "", t)) >> 32
        tokens.append((core, xxhash.xxh64_intdigest(marks, 1) >> 32 if marks else 0))
    words, marks, again = [t[0] for t in tokens], [t[1] for t in tokens], 0x5851F42D4C957F2D
    found = [w * again & M for w in words] + [(m * again & M) + (1 << 60) & M for m in marks if m]
    found += [again if a == b else p for a, b, p in zip(words, words[1:], gram(words, (1,)))]
    return [x >> 64 - quality.BITS for x in found + gram([m + 7 for m in marks], (1,))]


def quality_kept(rows, labels, uniform):
    """``{row number: log weight}``, and the rows that are kept; rows are (id, text), labels {id: 0 or 1}, uniform per row."""
    own = [Counter(quality_buckets(text or "")) for _, text in rows]
    raw, good = sum(own, Counter()), sum((c for c, (i, _) in zip(own, rows) if labels.get(i)), Counter())
    size = 1 << quality.BITS
    log = lambda counts, b: math.log((counts[b] + quality.SMOOTHING) / (counts.total() + quality.SMOOTHING * size))
    weight = [math.fsum(n * (log(good, b) - log(raw, b)) for b, n in c.items()) for c in own]
    known = sorted((w, labels[i]) for w, (i, _) in zip(weight, rows) if i in labels)
    least = -math.inf
    if known and not all(y for _, y in known):
        edges = [known[0][0] - 2.0, *(w for w, _ in known), known[-1][0] + 2.0]
        cuts = [(sum(y for _, y in known[:i]) + sum(not y for _, y in known[i:]), -(b - a), (a + b) / 2) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        least = min(cuts)[2]
    keys = [w - math.log(-math.log(u)) for w, u in zip(weight, uniform)]
    k = sum(w >= least for w in weight)
    return weight, [x >= sorted(keys, reverse=True)[k - 1] for x in keys] if k else [False] * len(rows)


# SimHash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(rows):
    """The ids of (id, text) rows that are the least of their component."""
    prints = [(fingerprint(t), i) for i, t in rows]
    root = {i: i for _, i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (a, i) in enumerate(prints):
        for b, j in prints[:n]:
            if (a ^ b).bit_count() <= 4:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i for i in root if find(i) == i}


# Decontamination


def bare(text):
    return [w.strip(EDGES).lower() or w.lower() for w in re.findall(r"[^\x09-\x0D\x20]+", text or "")]


def leaks(docs, items):
    """``{(doc, item): score}`` of all pairs of (id, text) rows that are leaks; the alignment has a test of its own."""
    number, out = {}, {}
    numbered = lambda text: np.array([number.setdefault(w, len(number)) for w in bare(text)], np.uint64)
    wanted = [(i, numbered(item)) for i, item in items]
    for d, text in docs:
        passage = numbered(text)
        for i, own in wanted:
            if len(own):
                score = decontamination.smith_waterman(own, passage)[0] / (decontamination.MATCH * len(own))
                if score >= decontamination.SCORE:
                    out[d, i] = score
    return out


# Secrets

SHAPES = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"AKIA[A-Z0-9]+", r"[0-9a-f]+")


def secret_spans(text):
    """(start, kind, end) of all spans of a text."""
    found = []
    for kind, (shape, least) in enumerate(zip(SHAPES, (6, 20, 24))):
        found += [(m.start(), kind, m.end()) for m in re.finditer(shape, text) if len(m.group(m.re.groups)) >= least]
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        value = m.group()
        if any(a < m.end() and m.start() < b for a, _, b in found if _ < 3):
            continue
        path = re.fullmatch(r"[a-z0-9_/-]+", value) and re.match(r"/?[a-z0-9_-]+/", value) and "//" not in value
        if path or any(re.search(a, value) for a in secrets.ALLOWED):
            continue
        least = next(bits for shape, bits in secrets.CLASSES if re.fullmatch(shape, value))
        windows = (Counter(value[i : i + 20]).values() for i in range(len(value) - 19))
        if max(math.log2(20) - sum(c * math.log2(c) for c in w) / 20 for w in windows) >= least:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def masked(text):
    if text is None:
        return None
    out, upto = [], 0
    for start, _, end in secret_spans(text):
        if start >= upto:
            out += [text[upto:start], "[SECRET]"]
        upto = max(upto, end)
    return "".join(out) + text[upto:]


# Mixing


def mix(rows):
    """``{row number: (copies, size, source size, target)}`` of (id, text, source) rows."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    per = Counter()
    for (_, _, s), n in zip(rows, sizes):
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, list(order), sum(per.values())
    while free:
        share = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * per[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * per[s]
            rest -= 3 * per[s]
            free.remove(s)
    out = {}
    for s in order:
        units = math.floor(target[s] / per[s] * (1 << 32)) if per[s] else 0
        at = int(hashlib.md5(("42:n" if s is None else f"42:s{s}").encode()).hexdigest()[:8], 16)
        for i in sorted((i for i, r in enumerate(rows) if r[2] == s), key=lambda i: (sizes[i], rows[i][0] is None, rows[i][0] or 0)):
            out[i] = ((at + units) // (1 << 32) - at // (1 << 32), sizes[i], per[s], target[s])
            at += units
    return out
