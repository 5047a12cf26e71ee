"""Table constraints as checks: keys, required values, ranges, references, sizes.

Files have no constraints of their own, so the checks are queries that return the broken
rules. Row rules of a table cost one pass without a shuffle; key and reference checks
aggregate by key first, so copies of a key shrink before they travel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surtido.schemas import MAX_LENGTH

# table -> constraint name -> rows that break it
def _row_rules() -> dict[str, dict[str, Column]]:
    def null(name: str) -> Column:
        return F.col(name).isNull()

    def too_many_digits(name: str, kind: str) -> Column:
        return F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()

    rules = {
        "productos": {
            "id_producto not null": null("id_producto"),
            "nombre not null": null("nombre"),
            "precio_unitario not null": null("precio_unitario"),
            "precio_unitario decimal(10,2)": too_many_digits("precio_unitario", "decimal(10,2)"),
        },
        "ventas": {
            "fecha_venta not null": null("fecha_venta"),
            "unidades_vendidas not null": null("unidades_vendidas"),
            "unidades_vendidas > 0": F.col("unidades_vendidas") <= 0,
            "total_venta not null": null("total_venta"),
            "total_venta decimal(10,2)": too_many_digits("total_venta", "decimal(10,2)"),
        },
        "predicciones": {
            "fecha_prediccion not null": null("fecha_prediccion"),
            "confianza_modelo decimal(5,4)": too_many_digits("confianza_modelo", "decimal(5,4)"),
        },
    }
    for table, lengths in MAX_LENGTH.items():
        for name, size in lengths.items():
            rules[table][f"{name} varchar({size})"] = F.length(name) > size
    return rules


def row_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break each row rule: ``tabla, restriccion, filas``."""
    rules = _row_rules()[table]
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("restriccion"), F.col(f"`{name}`").alias("filas"))
        for name in rules
    ])
    return counted.select(F.explode(pairs).alias("r")).select(
        F.lit(table).alias("tabla"), "r.restriccion", "r.filas")


def broken_rows(df: DataFrame, table: str) -> DataFrame:
    """The rows themselves, each with the names of the rules it breaks."""
    names = F.array_compact(F.array(*[
        F.when(rule, F.lit(name)) for name, rule in _row_rules()[table].items()
    ]))
    return df.withColumn("restricciones", names).filter(F.size("restricciones") > 0)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values used more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("filas")).filter(F.col("filas") > 1)


def orphans(facts: DataFrame, productos: DataFrame) -> DataFrame:
    """Product codes of the facts that the catalogue lacks, with their number of rows."""
    used = facts.filter(F.col("id_producto").isNotNull()).groupBy("id_producto").agg(
        F.count(F.lit(1)).alias("filas"))
    return used.join(productos.select("id_producto"), "id_producto", "left_anti")


def with_known(facts: DataFrame, productos: DataFrame, name: str = "conocido") -> DataFrame:
    """The facts with a flag: is their product, if they name one, in the catalogue?"""
    known = productos.select("id_producto").distinct().withColumn("_hay", F.lit(True))
    tagged = facts.join(known, "id_producto", "left")
    return tagged.select(*facts.columns, (
        F.col("_hay").isNotNull() | F.col("id_producto").isNull()).alias(name))


def split_orphans(facts: DataFrame, productos: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lenient reference check: (rows with a known or no product, rows to set aside).

    Each side is one tagged pass; a job that wants both stores :func:`with_known` once.
    """
    tagged = with_known(facts, productos)
    return (tagged.filter("conocido").drop("conocido"),
            tagged.filter(~F.col("conocido")).drop("conocido"))


def _as_rules(row: DataFrame, table: str) -> DataFrame:
    """``tabla, restriccion, filas`` from one row with a count per rule."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("restriccion"), F.col(f"`{name}`").alias("filas"))
        for name in row.columns
    ])
    return row.select(F.explode(pairs).alias("r")).select(
        F.lit(table).alias("tabla"), "r.restriccion", "r.filas")


def _sums(counts: DataFrame, names: list[str]) -> DataFrame:
    return counts.agg(*[F.coalesce(F.sum(f"`{n}`"), F.lit(0)).cast("bigint").alias(n)
                        for n in names])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """One row, ``repetidas``: rows beyond the first one of their whole-number key.

    32,768 neighbouring keys are one bitmap. Keys that follow each other, as generated ones
    do, collapse inside each task, and what travels is a bitmap per range, not a row per key.
    """
    value = F.col(key).cast("bigint")
    ranges = df.where(value.isNotNull()).groupBy(F.bitmap_bucket_number(value).alias("tramo")).agg(
        F.count(F.lit(1)).alias("filas"),
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("claves"))
    return ranges.agg(F.coalesce(
        F.sum(F.col("filas") - F.bitmap_count("claves")), F.lit(0)).alias("repetidas"))


def _check_products(productos: DataFrame) -> DataFrame:
    """Row rules and key of the catalogue, in one pass."""
    rules = _row_rules()["productos"]
    repeated = "id_producto primary key"
    counts = productos.groupBy("id_producto").agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        F.count(F.lit(1)).alias("filas"))
    counts = counts.withColumn(repeated, F.when(
        F.col("id_producto").isNotNull(), F.col("filas") - 1).otherwise(0))
    return _as_rules(_sums(counts, [*rules, repeated]), "productos")


def _check_facts(facts: DataFrame, table: str, productos: DataFrame, key: str) -> DataFrame:
    """Row rules, references and the whole-number key of a fact table, in one scan.

    A row counts twice in one aggregate: for its product, and as a bit among the 64 keys
    around its own. Both are summed inside each task before the shuffle: a hot product is a
    row per task, and generated keys, which follow each other, a word of bits for 64 rows.
    """
    rules = _row_rules()[table]
    unknown, repeated = "id_producto references productos", f"{key} primary key"
    nothing = F.lit(0).cast("bigint")
    product = F.struct(
        F.col("id_producto"), F.lit(None).cast("bigint").alias("_tramo"),
        F.lit(None).cast("bigint").alias("_bit"), F.lit(1).cast("bigint").alias("_filas"),
        *[F.coalesce(rule, F.lit(False)).cast("bigint").alias(name)
          for name, rule in rules.items()])
    parts = [product]
    if key in facts.columns:
        value = F.col(key).cast("bigint")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                              F.pmod(value, F.lit(64)).cast("int"))
        parts.append(F.when(value.isNotNull(), F.struct(
            F.lit(None).cast("string").alias("id_producto"),
            F.shiftright(value, 6).alias("_tramo"), bit.alias("_bit"),
            nothing.alias("_filas"), *[nothing.alias(name) for name in rules])))
    pairs = facts.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).select("p.*")
    sums = [F.sum(f"`{name}`").alias(name) for name in rules]
    grouped = pairs.groupBy("id_producto", "_tramo").agg(
        *sums, F.sum("_filas").alias("_filas"),
        (F.count("_bit") - F.coalesce(F.bit_count(F.bit_or("_bit")), F.lit(0))).alias(repeated))
    # The words of keys have no product: they are one group before the references are joined.
    counts = grouped.groupBy("id_producto").agg(
        *sums, F.sum("_filas").alias("_filas"), F.sum(f"`{repeated}`").alias(repeated))
    known = productos.select("id_producto").distinct().withColumn("_hay", F.lit(True))
    counts = counts.join(known, "id_producto", "left").withColumn(unknown, F.when(
        F.col("id_producto").isNotNull() & F.col("_hay").isNull(), F.col("_filas")).otherwise(0))
    named = [*rules, unknown] + [repeated] * (len(parts) > 1)
    return _as_rules(_sums(counts, named), table)


def validate_constraints(productos: DataFrame, ventas: DataFrame,
                         predicciones: DataFrame) -> DataFrame:
    """Every constraint with the number of rows that break it (0 where it holds).

    For a key these are the rows beyond the first one, which a database would refuse.
    """
    return reduce(DataFrame.unionByName, (
        _check_products(productos),
        _check_facts(ventas, "ventas", productos, "id_venta"),
        _check_facts(predicciones, "predicciones", productos, "id_prediccion"),
    ))
