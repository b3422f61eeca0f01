"""A keyed permutation of the whole numbers below n, as a Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
#: Steps of the cycle walk. Fewer than sqrt(n) of the network's points lie
#: outside, so a walk of this length ends for every n below 1000 and with all but
#: a probability of n**-20 beyond that. A walk that still hasn't ended is an error.
WALK = 40


def permute(x: Column, n: Column, seed: int, tweak: Column | None = None) -> Column:
    """Where the permutation of 0..n-1 that ``seed`` (and ``tweak``) names puts ``x``.

    A Feistel network over Z_a x Z_b, with a = ceil(sqrt(n)) and b = ceil(n / a),
    permutes slightly more points than n; a point that leaves the range is put
    through the network again until it is back (cycle walking). x must lie in
    the range; n = 0 has no points and gives null.
    """
    n = n.cast("long")
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    size = F.struct(
        n.alias("n"), a.alias("a"), F.ceil(n / a).cast("long").alias("b"),
        (tweak if tweak is not None else F.lit(0)).cast("long").alias("t"),
    )

    def network(v: Column, z: Column) -> Column:
        def half(s: Column, i: Column) -> Column:
            mix = lambda y: F.xxhash64(F.lit(seed), i, z["t"], y)
            return F.when(
                i % 2 == 0,
                F.struct(F.pmod(s["l"] + F.pmod(mix(s["r"]), z["a"]), z["a"]).alias("l"), s["r"].alias("r")),
            ).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(mix(s["l"]), z["b"]), z["b"]).alias("r")))

        start = F.struct(F.floor(v / z["b"]).cast("long").alias("l"), (v % z["b"]).alias("r"))
        return F.aggregate(
            F.array(*[F.lit(i) for i in range(ROUNDS)]), start, half, lambda s: s["l"] * z["b"] + s["r"]
        )

    def walk(z: Column) -> Column:
        end = F.aggregate(
            F.sequence(F.lit(1), F.lit(WALK)),
            network(x.cast("long"), z),
            lambda v, _: F.when(v < z["n"], v).otherwise(network(v, z)),
        )
        inside = lambda v: F.when(v < z["n"], v).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))
        return F.element_at(F.transform(F.array(end), inside), 1)

    # transform() over one struct binds a and b, so that they are computed once for a row
    return F.when(n > 0, F.element_at(F.transform(F.array(size), walk), 1))
