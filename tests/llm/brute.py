"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def pii(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []

    def add(kind, pattern, valid):
        out.extend((kind, m.start(), m.end()) for m in re.finditer(pattern, text) if valid(re.sub("[^0-9]", "", m[0]), m[0]))

    add("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, m: True)
    add("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, m: all(int(x) <= 255 for x in m.split(".")))
    add("card", r"[0-9]([\x20-]?[0-9])+", lambda d, m: 16 <= len(d) <= 19 and luhn(d))
    add("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, m: 8 <= len(d) <= 15)
    return out


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(spans) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    kinds = ("assign", "access", "hex")
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], kinds.index(x[0])))


def shingle_set(text: str | None, k: int = 5) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components(sets: list[frozenset], percent: int = 80) -> list[int]:
    """For every index, the smallest index reachable by links."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]
