"""Registration and the SQL spelling of the hash draws."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.draws import poisson_steps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# --- SQL spellings -----------------------------------------------------------------------

def sql_uniform(seed: int, salt: str, key: str) -> str:
    return (f"((('0x'||substr(md5('{seed}|{salt}|'||({key})::VARCHAR),1,13))::BIGINT)::DOUBLE + 0.5::DOUBLE)"
            f"/4503599627370496::DOUBLE")


def sql_rank(seed: int, key: str, salt: str = "rank") -> str:
    return f"('0x'||substr(md5('{seed}|{salt}|'||({key})::VARCHAR),1,15))::BIGINT"


def sql_round(x: str, dp: int) -> str:
    if dp == 0:
        return f"round_even(({x})::DOUBLE, 0)"
    scale = f"1e{dp}::DOUBLE"
    return f"(round_even(({x})::DOUBLE*{scale}, 0)/{scale})"


def sql_round_decimal(x: str, dp: int) -> str:
    """By the exact binary value; ``x`` must be a plain column, as it is repeated."""
    scale = f"1e{dp}::DOUBLE"
    p, split = f"({x}*{scale})", f"({x}*134217729::DOUBLE)"
    high = f"({split} - ({split} - {x}))"
    error = f"(({high}*{scale} - {p}) + ({x} - {high})*{scale})"
    tie = f"abs({p} - round_even({p}, 0)) = 0.5::DOUBLE"
    return (f"(CASE WHEN {tie} AND {error} > 0 THEN ceil({p}) WHEN {tie} AND {error} < 0 THEN floor({p}) "
            f"ELSE round_even({p}, 0) END/{scale})")


def sql_literal(v) -> str:
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def sql_case(steps: Sequence[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in steps) + f" ELSE {default} END"


def sql_cut(x: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    steps = [(f"{x} > {lo} AND {x} <= {hi}", sql_literal(v)) for lo, hi, v in zip(edges[:-1], edges[1:], labels)]
    return sql_case(steps, "NULL")


def sql_choice(u: str, values: Sequence) -> str:
    listed = ", ".join(sql_literal(v) for v in values)
    return f"[{listed}][(floor({u}*{len(values)}::DOUBLE))::BIGINT + 1]"


def sql_draw(kind: str, args: Sequence, seed: int, name: str, key: str) -> str:
    """SQL of one column of a synthesis spec."""
    u = sql_uniform(seed, name, key)
    if kind == "choice":
        out = sql_choice(u, args[0])
        return out if isinstance(args[0][0], str) else f"({out})::INTEGER"
    if kind == "weighted":
        total, steps = 0.0, []
        for v, p in zip(args[0][:-1], args[1][:-1]):
            total = round(total + p, 12)
            steps.append((f"{u} < {total}::DOUBLE", sql_literal(v)))
        return sql_case(steps, sql_literal(args[0][-1]))
    if kind == "integer":
        return f"({args[0]} + floor({u}*{args[1] - args[0]}::DOUBLE))::BIGINT"
    if kind == "real":
        return sql_round(f"{args[0]}::DOUBLE + {u}*{args[1] - args[0]}::DOUBLE", args[2])
    if kind == "poisson":
        steps = poisson_steps(args[0])
        return f"({sql_case([(f'{u} < {p!r}::DOUBLE', str(k)) for k, p in enumerate(steps)], str(len(steps)))})::BIGINT"
    z = sql_normal(seed, name, key)
    x = f"{args[0]}::DOUBLE + {args[1]}::DOUBLE*{z}"
    if kind == "normal":
        return sql_round(x, args[2])
    if kind == "folded_normal":
        return sql_round(f"abs({x})", args[2])
    if kind == "clipped_normal":
        return sql_round(f"least(greatest({x}, {args[2]}::DOUBLE), {args[3]}::DOUBLE)", args[4])
    if kind == "lognormal":
        return sql_round(f"exp({x})", args[2])
    raise ValueError(kind)


def sql_normal(seed: int, name: str, key: str) -> str:
    return (f"sqrt(-2::DOUBLE*ln({sql_uniform(seed, name + '.a', key)}))"
            f"*cos(6.283185307179586::DOUBLE*{sql_uniform(seed, name + '.b', key)})")
