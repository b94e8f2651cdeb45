"""Plain-Python versions of the operators, for small fixtures."""

from __future__ import annotations

import base64
import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def roots(nodes, links):
    """Smallest node reachable, by node."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, bits=4):
    """{(id, fingerprint hex, component)} of (id, text) pairs."""
    prints = [(i, simhash(t)) for i, t in docs]
    distinct = sorted({f for _, f in prints})
    links = [(a, b) for n, a in enumerate(distinct) for b in distinct[:n] if (a ^ b).bit_count() <= bits]
    root = roots(distinct, links)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for i, f in prints), key=str)


def warc(pages, least=0):
    """[(id, bytes, digest, type, refers_to)] of (id, html) pairs."""
    origin = {}
    for i, html in pages:
        if i is not None:
            origin[html or ""] = max(i, origin.get(html or "", i))
    out = []
    for i, html in pages:
        data = (html or "").encode()
        first = origin.get(html or "")
        again = len(data) >= least and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
OPAQUE = re.compile("[A-Za-z0-9+/]{40,}")
ENDPOINT = re.compile(r"(?:https?|s3|ftp|postgres|mysql|redis|amqp)://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+")


def secrets(text, scope=400):
    """(n_assign, n_access, n_hex, base sha256, spans) of a text."""
    text = text or ""
    # letters of either case are ASCII letters only
    plain = "".join(c if c < "\x80" else "￿" for c in text)
    base = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(plain) if len(m[2]) >= 6]
    base += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    base.sort()
    starts = lambda kinds: [b[0] for b in base if b[2] in kinds]
    near = lambda at, kinds: any(abs(at - s) <= scope for s in starts(kinds))
    more = []
    for m in OPAQUE.finditer(text):
        if near(m.start(), ("access",)) and not any(b[0] < m.end() and m.start() < b[3] for b in base):
            more.append((m.start(), 3, "opaque", m.end()))
    more += [(m.start(), 4, "endpoint", m.end()) for m in ENDPOINT.finditer(text) if near(m.start(), ("access", "assign"))]
    join = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
    count = lambda kind: sum(b[2] == kind for b in base)
    return count("assign"), count("access"), count("hex"), hashlib.sha256(join(base).encode()).hexdigest(), join(base + more)


def repeats(texts, length=400):
    """(n_bytes, n_removed, n_spans, kept sha256) of each text, by a table of all strings."""
    datas = [(t or "").encode() for t in texts]
    places: dict = {}
    for n, data in enumerate(datas):
        for i in range(len(data) - length + 1):
            key = hashlib.blake2b(data[i : i + length], digest_size=16).digest()
            places[key] = (n, i) if key not in places else None
    out = []
    for n, data in enumerate(datas):
        gone = bytearray(len(data))
        until = 0
        for i in range(len(data) - length + 1):
            key = hashlib.blake2b(data[i : i + length], digest_size=16).digest()
            if places[key] is None:
                start = max(i, until)
                gone[start : i + length] = b"\x01" * (i + length - start)
                until = i + length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal_data(text):
    """(n_email, n_ip, n_card, n_phone, base sha256) of a text, by the patterns as they are stated."""
    text = text or ""
    digits = lambda m: [int(c) for c in m[0] if c in "0123456789"]

    def luhn(d):
        return sum(n if i % 2 == 0 else sum(divmod(2 * n, 10)) for i, n in enumerate(d[::-1])) % 10 == 0

    kinds = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }
    base = ",".join(f"{k}:{s}:{e}" for k, spans in kinds.items() for s, e in sorted(spans))
    return *map(len, kinds.values()), hashlib.sha256(base.encode()).hexdigest()


def filter_audit(docs, labels):
    """Rows of the audit from (id, text, lang) and (id, quality, toxic), document by document."""
    from itertools import permutations

    good, toxic = ({i for i, *flags in labels if i is not None and flags[n] == 1} for n in (0, 1))
    parts: dict = {}
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            any(c in "#$%&*|" for c in text),
            any(i is not None and j is not None and j < i and (t or "") == text for j, t, _ in docs),
        ]
        parts.setdefault(lang or "", []).append(({f for f, x in zip("ABCDE", fails) if x}, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        counts, by_filter = {}, dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone, kept = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                redundant = sum(f in r[0] for r in rows) - len(gone)
                alone = sum(r[0] == {f} for r in rows)
                counts[order, step] = (len(kept), len(gone), redundant, alone, sum(r[1] for r in gone), sum(r[2] for r in gone))
                by_filter[f] += len(gone)
                left = kept
        out += [(part, o, s, *c, by_filter[o[s - 1]]) for (o, s), c in counts.items()]
    return sorted(out, key=str)


def prefix_trie(turns):
    """Rows of the trie from (conv_id, turn, role, text), node by node."""
    import zlib

    own: dict = {}
    for c, turn, role, text in turns:
        if c is not None:
            text = text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest()), (role or "", text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        paths[c] = tuple(own.get(first, [])[:h] + mine[h:])
    members: dict = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids: dict = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    totals: dict = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[k] for k in kids.get(node, ())]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if paths[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(kids.get(node, ())), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)
