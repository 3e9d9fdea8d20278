"""Brute-force twins of the corpus operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


def repeats(docs, least=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) for [(doc_id, text)]."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - least + 1):
            s = body[i:i + least]
            if s in seen:
                gone[i:i + least] = b"\1" * least
            seen.add(s)
        left = bytes(b for b, g in zip(body, gone) if not g)
        out[doc] = (len(body), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                    hashlib.sha256(left).hexdigest())
    return out


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked))


KINDS = ("assign", "access", "hex")


def base_secrets(text):
    """Spans (start, kind number, end) of the fixed kinds."""
    text, out = text or "", []
    # group 1 in either case, the rest as written
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n)
                     for n in ("password", "passwd", "secret", "token", "api_?key"))
    assign = rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for k, (pattern, ok) in enumerate((
            (assign, lambda m: len(m[2]) >= 8),
            (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
            (r"[0-9a-f]+", lambda m: len(m[0]) >= 32))):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return sorted(out)


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def shingles(text, k=4):
    w = words(fold(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def near_components(docs, percent=85):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= percent * (len(x) + len(y) - n):
                    ra, rb = sorted((root(a), root(b)))
                    up[rb] = ra
    return {d: (len(sets[d]), root(d)) for d in ids}


def unigram(docs):
    """doc_id -> (held_out, n_tokens, n_known, N, base score)."""
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    toks = {d: words(fold(t or "")) + [None] for d, t in docs}
    c = Counter(w for d in toks if not held[d] for w in toks[d])
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(t), sum(c[w] > 0 for w in t), n,
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for d, t in toks.items()}


class ByteTree:
    """Context-tree weighting computed node by node, all contexts kept."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.n = defaultdict(lambda: [0, 0])  # (context, prefix) -> zeros, ones
        for t in texts:
            for ctx, byte in self.walk(t):
                q = 1
                for i in range(7, -1, -1):
                    bit = byte >> i & 1
                    for d in range(depth + 1):
                        self.n[ctx[len(ctx) - d:], q][bit] += 1
                    q = q * 2 + bit
        self.memo = {}
        self.children = defaultdict(set)
        for ctx, q in self.n:
            if ctx:
                self.children[ctx[1:], q].add(ctx)

    def walk(self, text):
        b = bytes(self.depth) + fold(text or "").encode() + b"\0"
        for i in range(self.depth, len(b)):
            yield b[i - self.depth:i], b[i]

    @staticmethod
    def log_kt(a, b):
        return (math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1)
                - math.log(math.pi))

    def log_pw(self, ctx, q):
        if (ctx, q) not in self.memo:
            pe = self.log_kt(*self.n[ctx, q])
            if len(ctx) < self.depth:
                below = sum(self.log_pw(c, q) for c in self.children[ctx, q])
                hi, lo = max(pe, below), min(pe, below)
                pe = hi + math.log1p(math.exp(lo - hi)) - math.log(2)
            self.memo[ctx, q] = pe
        return self.memo[ctx, q]

    def p_one(self, ctx, q):
        p, weight = 0.0, 1.0
        for d in range(self.depth + 1):
            s = ctx[len(ctx) - d:]
            a, b = self.n.get((s, q), (0, 0))
            kt = (b + .5) / (a + b + 1)
            if d == self.depth or not (a or b):
                return p + weight * kt
            stop = math.exp(self.log_kt(a, b) - math.log(2) - self.log_pw(s, q))
            p, weight = p + weight * stop * kt, weight * (1 - stop)
        return p

    def log10(self, text):
        total = 0.0
        for ctx, byte in self.walk(text):
            q = 1
            for i in range(7, -1, -1):
                one = self.p_one(ctx, q)
                bit = byte >> i & 1
                total += math.log10(one if bit else 1 - one)
                q = q * 2 + bit
        return total
