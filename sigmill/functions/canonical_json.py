"""JSON in one canonical form (sorted keys, numbers as JavaScript writes them), its hash, pruning, and signatures."""

from __future__ import annotations

import hashlib
import json
import math
import os
import time

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType


def js_number(x: float | int) -> str:
    """A number as JavaScript prints it: shortest digits, exponent from 1e21 and below 1e-6."""
    if isinstance(x, int):
        x = float(x) if abs(x) >= 2**53 else x
        if isinstance(x, int):
            return str(x)
    if not math.isfinite(x):
        raise ValueError("only finite numbers have a canonical form")
    if x == 0:
        return "0"
    sign = "-" if x < 0 else ""
    mantissa = repr(abs(x))
    base, _, e = mantissa.partition("e")
    whole, _, part = base.partition(".")
    point = len(whole) + (int(e) if e else 0)
    raw = (whole + part).lstrip("0")
    point -= len(whole + part) - len((whole + part).lstrip("0"))
    raw = raw.rstrip("0")
    k = len(raw)
    if k <= point <= 21:
        return sign + raw + "0" * (point - k)
    if 0 < point <= 21:
        return sign + raw[:point] + "." + raw[point:]
    if -6 < point <= 0:
        return sign + "0." + "0" * -point + raw
    shown = raw[0] + ("." + raw[1:] if k > 1 else "")
    return f"{sign}{shown}e{'+' if point > 0 else '-'}{abs(point - 1)}"


def canonical(v) -> str:
    """Keys sorted by UTF-16 code units, no blanks, shortest escapes."""
    if isinstance(v, bool) or v is None:
        return json.dumps(v)
    if isinstance(v, (int, float)):
        return js_number(v)
    if isinstance(v, str):
        return json.dumps(v, ensure_ascii=False)
    if isinstance(v, list):
        return "[" + ",".join(canonical(x) for x in v) + "]"
    keys = sorted(v, key=lambda k: k.encode("utf-16-be"))
    return "{" + ",".join(json.dumps(k, ensure_ascii=False) + ":" + canonical(v[k]) for k in keys) + "}"


def pruned(v):
    """Without null, false, zero, empty texts, lists and objects, at every depth; None if nothing is left."""
    if isinstance(v, dict):
        out = {k: y for k, x in v.items() if (y := pruned(x)) is not None}
        return out or None
    if isinstance(v, list):
        out = [y for x in v if (y := pruned(x)) is not None]
        return out or None
    return None if v is None or v is False or v == 0 or v == "" else v


def _map_text(f):
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else f(json.loads(t))
            except (ValueError, RecursionError):
                return None

        return s.map(one)

    return F.pandas_udf(run, StringType())


def canonical_json(c):
    """Canonical form of a JSON text; null for null and for what is no JSON."""
    return _map_text(canonical)(c)


def pruned_json(c):
    return _map_text(lambda v: None if pruned(v) is None else canonical(pruned(v)))(c)


def uuid7(now_ms: int | None = None, rand: bytes | None = None) -> str:
    """Time-ordered UUID; materialise it once, it isn't deterministic."""
    ms = int(time.time() * 1000) if now_ms is None else now_ms
    b = bytearray(ms.to_bytes(6, "big") + (rand or os.urandom(10)))
    b[6] = b[6] & 0x0F | 0x70
    b[8] = b[8] & 0x3F | 0x80
    h = b.hex()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


# Ed25519 as RFC 8032 defines it, in plain integers.
P = 2**255 - 19
Q = 2**252 + 27742317777372353535851937790883648493
D = -121665 * pow(121666, P - 2, P) % P


def _add(a, b):
    x = (a[1] - a[0]) * (b[1] - b[0]) % P
    y = (a[1] + a[0]) * (b[1] + b[0]) % P
    t, z = 2 * a[3] * b[3] * D % P, 2 * a[2] * b[2] % P
    e, f, g, h = y - x, z - t, z + t, y + x
    return e * f % P, g * h % P, f * g % P, e * h % P


def _mul(k, a):
    out = (0, 1, 1, 0)
    while k:
        if k & 1:
            out = _add(out, a)
        a = _add(a, a)
        k >>= 1
    return out


def _root(y, sign):
    x2 = (y * y - 1) * pow(D * y * y + 1, P - 2, P) % P
    if y >= P or not x2 and sign:
        return None
    x = pow(x2, (P + 3) // 8, P)
    if (x * x - x2) % P:
        x = x * pow(2, (P - 1) // 4, P) % P
    if (x * x - x2) % P:
        return None
    return P - x if x & 1 != sign else x


_GY = 4 * pow(5, P - 2, P) % P
_GX = _root(_GY, 0)
G = (_GX, _GY, 1, _GX * _GY % P)


def _pack(a):
    z = pow(a[2], P - 2, P)
    return (a[1] * z % P | (a[0] * z % P & 1) << 255).to_bytes(32, "little")


def _unpack(b):
    n = int.from_bytes(b, "little")
    y, sign = n & ((1 << 255) - 1), n >> 255
    x = _root(y, sign)
    return None if x is None else (x, y, 1, x * y % P)


def _hash(b):
    return int.from_bytes(hashlib.sha512(b).digest(), "little") % Q


def _secret(key: bytes):
    h = hashlib.sha512(key).digest()
    return int.from_bytes(h[:32], "little") & ((1 << 254) - 8) | 1 << 254, h[32:]


def public_key(key: bytes) -> bytes:
    return _pack(_mul(_secret(key)[0], G))


def sign(key: bytes, message: bytes) -> bytes:
    a, prefix = _secret(key)
    pub = _pack(_mul(a, G))
    r = _hash(prefix + message)
    top = _pack(_mul(r, G))
    return top + ((r + _hash(top + pub + message) * a) % Q).to_bytes(32, "little")


def verify(pub: bytes, message: bytes, signature: bytes) -> bool:
    if len(pub) != 32 or len(signature) != 64:
        return False
    a, r, s = _unpack(pub), _unpack(signature[:32]), int.from_bytes(signature[32:], "little")
    if a is None or r is None or s >= Q:
        return False
    left, right = _mul(s, G), _add(r, _mul(_hash(signature[:32] + pub + message), a))
    return not (left[0] * right[2] - right[0] * left[2]) % P and not (left[1] * right[2] - right[1] * left[2]) % P


def verified(digest, signature, key):
    """Column: the hex signature over a hex digest is valid for the hex key; null where one of them is."""

    def run(d: pd.Series, s: pd.Series, k: pd.Series) -> pd.Series:
        def one(a, b, c):
            try:
                return None if a is None or b is None or c is None else verify(bytes.fromhex(c), bytes.fromhex(a), bytes.fromhex(b))
            except ValueError:
                return False

        return pd.Series([one(*x) for x in zip(d, s, k)], dtype="object")

    return F.pandas_udf(run, BooleanType())(digest, signature, key)
