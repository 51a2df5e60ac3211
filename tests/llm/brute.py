"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

KINDS = ("email", "ip", "card", "phone")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    found = []
    for place, (kind, pattern) in enumerate(
        zip(
            KINDS,
            (
                r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+",
                r"\+[0-9][\x20().0-9-]+[0-9]",
            ),
            strict=True,
        )
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), place, kind, m.end()))
    return sorted(found)


def shingles(text: str | None, size: int) -> frozenset:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def linked(sets: list[frozenset], similarity: int = 80) -> list[tuple[int, int]]:
    """All pairs of places of alike sets, found by the shingles they share."""
    holders, shared = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            for j in holders[x]:
                shared[j, i] += 1
            holders[x].append(i)
    return [
        (i, j) for (i, j), n in shared.items() if 100 * n >= similarity * (len(sets[i]) + len(sets[j]) - n)
    ]


def roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def crc(doc_id: int | None) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def host_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def rule(host: str, path: str) -> tuple[str | None, str | None]:
    fits = [(h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def verdicts(pages: list[tuple[int, str | None, str | None]], rounds: int = 400) -> dict[int, tuple[str, float, float]]:
    """(verdict, trust, distrust) of each page: ranks of hosts over absolute links between different hosts."""
    places = {i: host_path(url) for i, url, _ in pages}
    said = {i: rule(*at)[1] for i, at in places.items()}
    arcs: dict[str, set] = {"allow": set(), "block": set()}
    for i, _, html in pages:
        for found in re.findall(r"""href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "", re.I):
            a, b = places[i][0], "".join(c.lower() if "A" <= c <= "Z" else c for c in found)
            if a and b and a != b:
                arcs["allow"].add((a, b))
                arcs["block"].add((b, a))
    ranks = {}
    for kind, links in arcs.items():
        hosts = Counter(places[i][0] for i in said if said[i] == kind and places[i][0])
        start = {h: n / hosts.total() for h, n in hosts.items()}
        degrees = Counter(a for a, _ in links)
        mass = dict(start)
        for _ in range(rounds):
            following = defaultdict(float, {h: 0.15 * m for h, m in start.items()})
            for a, b in links:
                following[b] += 0.85 * mass.get(a, 0.0) / degrees[a]
            mass = dict(following)
        ranks[kind] = mass
    result = {}
    for i, (host, _) in places.items():
        trust, distrust = ranks["allow"].get(host, 0.0), ranks["block"].get(host, 0.0)
        result[i] = (said[i] or ("block" if distrust > trust else "allow"), trust, distrust)
    return result


def plain_words(text: str | None) -> list[bytes]:
    """Words as the decontamination reads them."""
    raw = bytes(
        c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32
        for c in (text or "").encode()
    )
    return raw.split()


def leaks(text: str | None, items: list[tuple[int, str]], similarity: float = 0.8) -> dict[int, float]:
    """Items that some passage of the item's length is alike to, by counted five-word shingles."""
    words = plain_words(text)
    sets = [(i, plain_words(t)) for i, t in items]
    cut = lambda w: Counter(tuple(w[k : k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1))
    held = Counter(s for _, w in sets for s in cut(w))
    weight = lambda s: held[s] ** -0.5 if s in held else 1.0
    found = {}
    for i, own in sets:
        a, known = cut(own), {w for s in cut(own) for w in s}
        for k in range(max(1, len(words) - len(own) + 1)):
            passage = words[k : k + len(own)]
            if not own or sum(w in known for w in passage) < 0.5 * len(own):
                continue
            b = cut(passage)
            both = sum(weight(s) * min(a[s], b[s]) for s in a)
            union = sum(weight(s) * max(a[s], b[s]) for s in a.keys() | b.keys())
            if union and both / union >= similarity:
                found[i] = max(found.get(i, 0), both / union)
    return found
