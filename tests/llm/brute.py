"""Plain Python versions of the operators that SQL can't express."""

import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def line_dedup(rows, min_chars=10):
    last = 2**63 - 1
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add(last if i is None else i)
    out = []
    for i, t in rows:
        own, lines = last if i is None else i, (t or "").split("\n")
        kept = [x for x in lines
                if len(key(x)) < min_chars or len(held[key(x)]) < 2 or min(held[key(x)]) == own]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def remove_repeats(rows, k=13):
    last = 2**63 - 1
    first = {}
    for i, t in rows:
        w, own = words(t), last if i is None else i
        for p in range(len(w) - k + 1):
            seq = tuple(w[p:p + k])
            first[seq] = min(first.get(seq, own), own)
    out = []
    for i, t in rows:
        w, own = words(t), last if i is None else i
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < own:
                gone[p:p + k] = [True] * k
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def simhash(text, n=3):
    import xxhash

    w = words(low(text or ""))
    shingles = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, bits=2):
    """Index of the class of each fingerprint, by all pairs."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                parent[root(a)] = root(b)
    return [root(x) for x in range(len(prints))]


def simhash_classes(rows):
    prints = [simhash(t) for _, t in rows]
    cls = classes(prints)
    first = {}
    for (i, _), c in zip(rows, cls):
        if i is not None:
            first[c] = min(first.get(c, i), i)
    return [(i, p, first.get(c)) for (i, _), p, c in zip(rows, prints, cls)]


def edit_distance(a, b, anywhere=False):
    """Edit distance; ``anywhere``: to the best part of ``b``."""
    prev = [0] * (len(b) + 1) if anywhere else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev) if anywhere else prev[-1]


def modified_discounts(counts):
    """Chen and Goodman's discounts for counts of 1, 2 and 3 or more, from how many
    n-grams occur 1, 2, 3 and 4 times; fixed ones where they aren't defined."""
    n = [sum(c == k for c in counts) for k in range(5)]
    if not n[1] or not n[2]:
        return [0.0, 0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    found = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2
        found.append(min(max(d, 0.05), k))
    return found


def kneser_ney(rows, trains, order=2):
    """(tokens, known, N, base, score) of each row, by counting n-grams as tuples."""
    from math import log10

    tok = [words(low(t or "")) + ["</s>"] for _, t in rows]
    padded = [["<s>"] * (order - 1) + w for w in tok]
    uni, counts = Counter(), {k: Counter() for k in range(1, order + 1)}
    for (i, _), w, p in zip(rows, tok, padded):
        if trains(i):
            uni.update(w)
            counts[order].update(tuple(p[j:j + order]) for j in range(len(w)))
    for k in range(order - 1, 0, -1):  # distinct words before
        counts[k].update(gram[1:] for gram in counts[k + 1])
    n, v = sum(uni.values()), len(uni)
    d = {k: modified_discounts(counts[k].values()) for k in counts}
    follow = {k: defaultdict(list) for k in counts}
    for k in counts:
        for gram, c in counts[k].items():
            follow[k][gram[:-1]].append(c)

    def probability(gram):
        k = len(gram)
        lower = probability(gram[1:]) if k > 1 else 1 / (v + 1)
        seen = follow[k].get(gram[:-1])
        if not seen:
            return lower
        own = counts[k][gram]
        kept = max(own - d[k][min(own, 3)], 0)
        return (kept + sum(d[k][min(c, 3)] for c in seen) * lower) / sum(seen)

    out = []
    for w, p in zip(tok, padded):
        base = sum(log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = sum(log10(probability(tuple(p[j:j + order]))) for j in range(len(w)))
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def smallest_capacity(sizes, shards):
    low_, high = max(sizes), sum(sizes)
    while low_ < high:
        mid, used, now = (low_ + high) // 2, 1, 0
        for x in sizes:
            if now + x > mid:
                used, now = used + 1, 0
            now += x
        low_, high = (low_, mid) if used <= shards else (mid + 1, high)
    return low_


# -- piecewise hashing, one byte at a time ----------------------------------------------

_M32, _M64 = 2**32 - 1, 2**64 - 1


def _trigger(data, at):
    h = 0
    for back in range(7):
        if at >= back:
            h += (data[at - back] + 1) * pow(0x01000193, back, 2**32)
    h &= _M32
    h = (h ^ h >> 15) * 0x2C1B3C6D & _M32
    return (h ^ h >> 13) + 1 & _M32


def _piece_letter(piece):
    h = sum((byte + 1) * pow(0x9E3779B97F4A7C15, k, 2**64) for k, byte in enumerate(piece)) + len(piece) & _M64
    h = (h ^ h >> 33) * 0xFF51AFD7ED558CCD & _M64
    h = (h ^ h >> 33) * 0xC4CEB9FE1A85EC53 & _M64
    h ^= h >> 33
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[h >> 58]


def ctph(data):
    """Fingerprint of bytes: the smallest block with fewer than 64 piece ends."""
    triggers = [_trigger(data, i) for i in range(len(data))]
    block = 3
    while data and sum(t % block == 0 for t in triggers) >= 64:
        block *= 2
    signatures = []
    for size in (block, 2 * block):
        cuts = [0] + [i + 1 for i, t in enumerate(triggers) if t % size == 0]
        cuts += [len(data)] if cuts[-1] < len(data) else []
        signatures.append("".join(_piece_letter(data[a:b]) for a, b in zip(cuts, cuts[1:])))
    return f"{block}:{signatures[0]}:{signatures[1]}"


def ctph_likeness(x, y):
    if x == y:
        return 1.0
    (bx, *sx), (by, *sy) = x.split(":"), y.split(":")
    sides = {int(bx) * (k + 1): s for k, s in enumerate(sx)}, {int(by) * (k + 1): s for k, s in enumerate(sy)}
    best = 0.0
    for block in sides[0].keys() & sides[1].keys():
        p, q = sides[0][block], sides[1][block]
        if p and q:
            alike = 1 - edit_distance(p, q) / max(len(p), len(q))
            best = max(best, alike * min(1, min(len(p), len(q)) / 4))
    return best


# -- readings of a token, all of them -----------------------------------------------------


def all_readings(token, lattice, cost, symbol):
    """Least cost of each text that a path through the lattice spells."""
    paths = [("", 0.0)]
    for choices in lattice(token):
        paths = [(text + out, price + own) for text, price in paths for out, own in choices]
    found = {}
    for text, price in paths:
        context = (0, 0, 0)
        for c in text:
            price += float(cost[context + (symbol(c),)])
            context = (*context[1:], symbol(c))
        price += float(cost[context + (0,)])
        found[text] = min(found.get(text, price), price)
    return found


# -- the gated network, one unit at a time --------------------------------------------------


def _gru_states(net, text):
    from math import exp, tanh

    h, states, state = net.hidden, [], [0.0] * net.hidden
    for byte in text:
        dot = lambda row: sum(float(net.u[row, k]) * state[k] for k in range(h))  # noqa: E731,B023
        z = [1 / (1 + exp(-(float(net.x[i, byte]) + dot(i)))) for i in range(h)]
        r = [1 / (1 + exp(-(float(net.x[h + i, byte]) + dot(h + i)))) for i in range(h)]
        new = [tanh(float(net.x[2 * h + i, byte]) + r[i] * (dot(2 * h + i) + float(net.c[i, 0]))) for i in range(h)]
        state = [z[i] * state[i] + (1 - z[i]) * new[i] for i in range(h)]
        states.append(state)
    return states


def gru_document(net, text, step):
    """Mean probabilities over a text's letters (bytes of letters), read in stretches."""
    from math import exp

    total, n = [0.0] * len(net.langs), 0
    for at in range(0, len(text), step):
        part = text[at:at + step]
        ahead, back = _gru_states(net.ahead, part), _gru_states(net.back, part[::-1])[::-1]
        for byte, a, b in zip(part, ahead, back):
            if not (65 <= byte <= 90 or 97 <= byte <= 122 or byte >= 128):
                continue
            out = [sum(float(net.v[k, i]) * x for i, x in enumerate(a + b)) + float(net.b[k, 0]) for k in range(len(net.langs))]
            e = [exp(x - max(out)) for x in out]
            total = [t + x / sum(e) for t, x in zip(total, e)]
            n += 1
    return [t / max(n, 1) for t in total]
