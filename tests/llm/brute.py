"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text.translate(LOWER)) if text else []


def shingles(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard_classes(docs, threshold=0.8):
    """{key: (class, links)} of (key, text) pairs with different keys."""
    sets = [(key, shingles(text)) for key, text in docs]
    root = {key: key for key, _ in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = defaultdict(int)
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and len(s & t) >= threshold * len(s | t) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: (find(key), links[key]) for key, _ in docs}


def contamination(docs, items, window=13):
    """{key: (n_words, n_hit, n_items, sha, contaminated)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[s : s + size])].add(str(item))
    out = {}
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in windows:
                    found |= windows[tuple(w[s : s + size])]
                    hit |= set(range(s, s + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[key] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


KINDS = [
    (
        "assign",
        re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base_spans(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def line_dedup(docs, min_lines=2, min_chars=30):
    """{key: kept text} of (key, text) pairs in order, keys distinct."""
    seen_lines, seen_runs, out = set(), set(), {}
    for key, text in docs:
        if text is None:
            out[key] = None
            continue
        lines = text.split("\n")
        full = [(i, x.strip(" ")) for i, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for at, (i, line) in enumerate(full):
            if line in seen_lines and len(line) >= min_chars:
                gone.add(i)
            seen_lines.add(line)
            run = tuple(x for _, x in full[at : at + min_lines])
            if len(run) == min_lines:
                if run in seen_runs:
                    gone |= {j for j, _ in full[at : at + min_lines]}
                seen_runs.add(run)
        out[key] = "" if gone and len(gone) == len(full) else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def repeats(docs, size=50):
    """{key: set of word places} inside verbatim repeats across (key, text) pairs."""
    where = defaultdict(set)
    for key, text in docs:
        w = words(text)
        for s in range(len(w) - size + 1):
            where[tuple(w[s : s + size])].add(key)
    out = defaultdict(set)
    for key, text in docs:
        w = words(text)
        for s in range(len(w) - size + 1):
            if len(where[tuple(w[s : s + size])]) > 1:
                out[key] |= set(range(s, s + size))
    return out


def token_bytes(directory):
    """Both tokenizers and the bytes of their ids, read plainly from the vocabulary files."""
    import json

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(f"{directory}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=f"{directory}/piece_bpe_32k.model")
    shown = [n for n in [*range(33, 127), *range(161, 173), *range(174, 256)]]
    letters = {chr(n): n for n in shown}
    letters.update({chr(256 + i): n for i, n in enumerate(n for n in range(256) if n not in shown)})
    with open(f"{directory}/byte_bpe_50k.json", encoding="utf-8") as f:
        names = json.load(f)["model"]["vocab"]
    assert decoders.ByteLevel().decode(["Ġa"]) == " a"
    a_bytes = {i: bytes(letters[c] for c in name) for name, i in names.items()}

    def piece(name):
        return bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F][0-9A-F]>", name) else name.replace("▁", " ").encode()

    b_bytes = {i: piece(b.id_to_piece(i)) for i in range(b.vocab_size())}
    return a, b, a_bytes, b_bytes


def alignment(texts, directory):
    """[(n_a, n_b, n_groups, n_links, n_best, count_sum, groups)] of whole texts."""
    a, b, a_bytes, b_bytes = token_bytes(directory)
    found, counts = [], defaultdict(int)
    for text in texts:
        full = f" {text}".encode() if text else b""
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        if b"".join(a_bytes[i] for i in ids_a) != full or b"".join(b_bytes[i] for i in ids_b) != full:
            ids_a, ids_b = [], []
        ends = []
        for ids, size in ((ids_a, a_bytes), (ids_b, b_bytes)):
            at, own = 0, {}
            for n, i in enumerate(ids):
                at += len(size[i])
                own[at] = n
            ends.append(own)
        groups, links, last = [], [], (0, 0)
        for at in sorted(ends[0].keys() & ends[1].keys()):
            x, y = ends[0][at], ends[1][at]
            groups.append((ids_a[last[0] : x + 1], ids_b[last[1] : y + 1]))
            links.append((ids_a[x], ids_b[y]))
            last = x + 1, y + 1
        for pair in links:
            counts[pair] += 1
        found.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups),
        )
        for n_a, n_b, groups, links in found
    ], counts


def resampled(docs, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    """Sorted [(key, n_features, weight, score, rank)]."""
    import math
    import zlib

    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = defaultdict(int), defaultdict(int)
    for table, counts in ((docs, s), (target, t)):
        for _, text in table:
            for bucket in features(text):
                counts[bucket] += 1
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(bucket):
        return math.floor(1000 * math.log((t[bucket] + 1) * (all_s + buckets) / ((s[bucket] + 1) * (all_t + buckets))))

    rows = []
    for key, text in docs:
        own = features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words(text)) >= least, key, len(own), weight, score))
    drawn = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    quota = percent * len(drawn) // 100
    ranked = [(*r[1:], i + 1 if i < quota else None) for i, r in enumerate(drawn)] + [(*r[1:], None) for r in rows if not r[0]]
    return sorted(ranked, key=repr)


HOST_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_parts(url):
    if not url or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    after = rest[len(host) :]
    return host.translate(LOWER), re.match(r"[^?#]*", after).group(), host.translate(LOWER) + after


def url_rule(url):
    """(rule, verdict) of the host rules; verdict None where none fits."""
    host, path, _ = url_parts(url)
    fitting = [(len(h + p), len(h), h + p, a) for h, p, a in HOST_RULES if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    return max(fitting)[2:] if fitting else (None, None)
