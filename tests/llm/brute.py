"""Plain restatements of what the corpus queries return, for whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def exact_groups(docs):
    """{row number: (keep_id, size, sha)} and the ids that stay, of (id, text) rows."""
    groups = defaultdict(list)
    for doc, text in docs:
        groups[text or ""].append(doc)
    rows = sorted((d, max(ids), len(ids), sha(t)) for t, ids in groups.items() for d in ids)
    return rows


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def hamming_components(rows, bits=4):
    """{row number: smallest id reachable} of (id, fingerprint) rows, all pairs compared."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(rows))]


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """{source: target}, by giving the excess to the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(sum(weight[s] for s in free), 1)
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def token_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def pii_base(text):
    """{kind: spans} of the base kinds, by the fixed grammars."""
    text = text or ""
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    only = lambda s: re.sub("[^0-9]", "", s)
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(only(s)) <= 15),
    }
    return {k: [m.span() for m in re.finditer(p, text) if ok(m[0])] for k, (p, ok) in checks.items()}


def secret_base(text):
    """(kind, start, end) of the base kinds, by start and kind."""
    text = text or ""
    letters = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = [("assign", *m.span()) for m in re.finditer(rf"({letters})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))


def repeats(texts, length=200):
    """[(n_bytes, n_removed, n_spans, kept sha)] of the texts."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
