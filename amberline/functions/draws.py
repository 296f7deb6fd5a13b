"""Hash draws: random-looking columns that are a pure function of (seed, salt, key).

Unlike ``rand(seed)`` the value of a row does not depend on which partition
or which attempt computes it, so a retried task gives the same rows.
``method="xxhash64"`` is the cheap default; ``method="md5"`` costs several
times more and can be recomputed by any other engine.

The uniforms of a table go into one projection and the draws into the next:
Catalyst keeps the two apart because each uniform is used several times, so
no hash is computed twice.  Poisson counts look their step up in an array
rather than in a chain of twenty comparisons, which keeps the generated
method within what the JVM compiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 2**52
RANK_SPAN = 2**60

# The expressions are written as SQL text: one parse per column is much cheaper
# for the driver than building hundreds of Column objects one call at a time.


def literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{v!r}D" if isinstance(v, float) else repr(v)


def _bits(seed: int, salt: str, key: str, method: str, bits: int) -> str:
    """Leading bits of the hash, as a BIGINT expression; ``key`` is a column name."""
    if method == "md5":
        text = f"concat_ws('|', '{seed}', {literal(salt)}, CAST(`{key}` AS STRING))"
        return f"CAST(conv(substring(md5({text}), 1, {bits // 4}), 16, 10) AS BIGINT)"
    if method == "xxhash64":
        return f"shiftrightunsigned(xxhash64({seed}, {literal(salt)}, `{key}`), {64 - bits})"
    raise ValueError(f"unknown hash {method!r}")


def _uniform(seed: int, salt: str, key: str, method: str) -> str:
    return f"((CAST({_bits(seed, salt, key, method, 52)} AS DOUBLE) + 0.5D) / {float(UNIT)!r}D)"


def uniform(seed: int, salt: str, key: str, method: str = "xxhash64") -> Column:
    """52-bit uniform in the open interval (0, 1)."""
    return F.expr(_uniform(seed, salt, key, method))


def uniforms(seed: int, salts: Sequence[str], key: str, method: str = "xxhash64") -> Column:
    """Array of uniforms, one per salt, each equal to ``uniform`` with that salt."""
    return F.expr(f"array({', '.join(_uniform(seed, s, key, method) for s in salts)})")


def rank_hash(seed: int, key: str, method: str = "xxhash64", salt: str = "rank") -> Column:
    """60-bit hash that orders rows at random; the basis of samples, splits and folds."""
    return F.expr(_bits(seed, salt, key, method, 60))


# --- distributions; ``u`` is the SQL text of a uniform, best a reference to one ---------------

def _rounded(x: str, dp: int) -> str:
    return f"rint({x})" if dp == 0 else f"(rint(({x}) * {10.0**dp!r}D) / {10.0**dp!r}D)"


def choice(u: str, values: Sequence) -> Column:
    listed = ", ".join(literal(v) for v in values)
    return F.expr(f"element_at(array({listed}), CAST(floor({u} * {float(len(values))!r}D) AS INT) + 1)")


def weighted(u: str, values: Sequence, p: Sequence[float]) -> Column:
    steps, total = [], 0.0
    for value, share in zip(values[:-1], p[:-1]):
        total = round(total + share, 12)
        steps.append(f"WHEN {u} < {total!r}D THEN {literal(value)}")
    return F.expr(f"CASE {' '.join(steps)} ELSE {literal(values[-1])} END")


def integer(u: str, lo: int, hi: int) -> Column:
    """Integer uniform on [lo, hi)."""
    return F.expr(f"CAST({lo} + floor({u} * {float(hi - lo)!r}D) AS BIGINT)")


def real(u: str, lo: float, hi: float, dp: int) -> Column:
    return F.expr(_rounded(f"{float(lo)!r}D + {u} * {float(hi - lo)!r}D", dp))


def normal_text(u1: str, u2: str) -> str:
    """Box-Muller transform of two independent uniforms."""
    return f"(sqrt(-2.0D * ln({u1})) * cos({2.0 * math.pi!r}D * {u2}))"


#: Beyond it exp(-mean) leaves the range of normal numbers.
LARGEST_MEAN = 700


def poisson_steps(lam: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... until the rest is below 1e-12 or the next term is lost in rounding."""
    if not 0 <= lam <= LARGEST_MEAN:
        raise ValueError(f"a Poisson mean must lie between 0 and {LARGEST_MEAN}, not {lam}")
    term, total, steps = math.exp(-lam), 0.0, []
    k = 0
    while 1.0 - total > 1e-12 and (k <= lam or total + term > total):
        total += term
        steps.append(total)
        k += 1
        term *= lam / k
    return steps


def poisson(u: str, lam: float) -> Column:
    """Number of cumulative probabilities that are not above ``u``."""
    steps = ", ".join(literal(p) for p in poisson_steps(lam))
    return F.expr(f"CAST(size(filter(array({steps}), p -> p <= {u})) AS BIGINT)")


def uniforms_needed(kind: str) -> list[str]:
    """Suffixes of the uniforms a draw consumes."""
    return [".a", ".b"] if "normal" in kind else [""]


def draw(kind: str, args: Sequence, u: Sequence[str]) -> Column:
    """One column of a synthesis spec: ``kind`` names the distribution, ``args`` its parameters."""
    if kind == "choice":
        return choice(u[0], args[0])
    if kind == "weighted":
        return weighted(u[0], args[0], args[1])
    if kind == "integer":
        return integer(u[0], *args)
    if kind == "real":
        return real(u[0], *args)
    if kind == "poisson":
        return poisson(u[0], args[0])
    mean, sd, *rest = args
    x = f"({float(mean)!r}D + {float(sd)!r}D * {normal_text(*u)})"
    if kind == "normal":
        return F.expr(_rounded(x, rest[0]))
    if kind == "folded_normal":
        return F.expr(_rounded(f"abs({x})", rest[0]))
    if kind == "clipped_normal":
        lo, hi, dp = rest
        return F.expr(_rounded(f"least(greatest({x}, {float(lo)!r}D), {float(hi)!r}D)", dp))
    if kind == "lognormal":
        return F.expr(_rounded(f"exp({x})", rest[0]))
    raise ValueError(f"unknown draw {kind!r}")
