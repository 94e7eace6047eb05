"""Mergeable states of marts: sums, and sets of keys as bitmaps.

Distinct counts of two loads can't be added, but their sets can be united. Every key (a supplier, an invoice) has a number
that never changes, kept in a table of its own; a set of keys is then one bitmap of 4 KB per bucket of 32,768 numbers.
A state holds the sums and the bitmaps of one period. States of any periods are merged by adding the sums and by uniting
the bitmaps; the bits of the union are the exact distinct count. No step expands rows once per distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoice_lake.functions.codes import supplier_id
from invoice_lake.functions.periods import in_years
from invoice_lake.operators.matching import code_map

#: Numbers given in one run by one task lie within this range, so those of different tasks and runs never meet.
TASK_NUMBERS = 1 << 33
#: A row of a state counts for one product type or, once, for all of them.
BY_TYPE, ALL_TYPES = "tipo", "todos"
MART_KEY = ("escopo", "tipo", "ano")


def new_numbers(keys: DataFrame, known: DataFrame | None) -> DataFrame:
    """(chave, numero) of the keys (chave) that ``known`` lacks; numbers follow each other within a task.

    With ``ordem``, the numbers also follow the least ``ordem`` of a key: keys that come in the same period then share few
    bitmaps, where numbers in any order would set a few bits in each of very many.
    The numbers depend on how Spark deals the rows: write the result before it is used.
    """
    in_order = "ordem" in keys.columns
    fresh = keys.where("chave is not null")
    fresh = fresh.groupBy("chave").agg(F.min("ordem").alias("ordem")) if in_order else fresh.distinct()
    base = F.lit(0)
    if known is not None:
        fresh = fresh.join(known.select("chave"), "chave", "left_anti")
        highest = known.agg(F.max("numero")).first()[0]
        base = F.lit(0 if highest is None else (highest // TASK_NUMBERS + 1) * TASK_NUMBERS)
    if in_order:
        fresh = fresh.repartitionByRange("ordem", "chave").sortWithinPartitions("ordem", "chave")
    return fresh.select("chave", (F.monotonically_increasing_id() + base).alias("numero"))


def supplier_keys(items: DataFrame) -> DataFrame:
    return items.select(supplier_id().alias("chave"))


def invoice_keys(items: DataFrame) -> DataFrame:
    month = F.regexp_replace("periodo", r"\D", "").try_cast("int")  # a number, so that the least one is found by hash aggregation
    return items.select(F.col("chave_de_acesso").alias("chave"), month.alias("ordem"))


def typed_values(items: DataFrame, mapping: DataFrame, *keep: str) -> DataFrame:
    """Value per scope, type, year, invoice and supplier of the items with a mapped code.

    Under ``ALL_TYPES`` an item stands once, whatever number of types its code has. The items are read and joined once.
    """
    typed = code_map(mapping).withColumnRenamed("ncm", "codigo_ncm_sh")
    of_types = typed.select("codigo_ncm_sh", F.lit(BY_TYPE).alias("escopo"), "tipo")
    of_all = typed.select("codigo_ncm_sh", F.lit(ALL_TYPES).alias("escopo"), F.lit(None).cast("string").alias("tipo")).distinct()
    return items.join(of_types.unionByName(of_all), "codigo_ncm_sh").groupBy(
        *keep, "escopo", "tipo", F.year("data_emissao").cast("bigint").alias("ano"),
        "chave_de_acesso", supplier_id().alias("fornecedor"),
    ).agg(F.sum("valor_total").alias("valor"))


def sums(values: DataFrame, *keep: str) -> DataFrame:
    """The additive part of a state."""
    return values.groupBy(*keep, *MART_KEY).agg(F.sum("valor").alias("valor"))


def key_sets(values: DataFrame, keys: dict[str, tuple[str, DataFrame]], *keep: str) -> DataFrame:
    """The sets of a state: ``keys`` names each set with the column of its keys and their numbers (chave, numero)."""
    found = None
    for name, (column, numbers) in keys.items():
        per_key = values.where(F.col(column).isNotNull()).select(*keep, *MART_KEY, F.col(column).alias("chave")).distinct()
        numbered = per_key.join(numbers, "chave")
        part = numbered.groupBy(*keep, *MART_KEY, F.lit(name).alias("conjunto"), F.bitmap_bucket_number("numero").alias("balde")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("bits"))
        found = part if found is None else found.unionByName(part)
    return found


def merged_sums(states: DataFrame) -> DataFrame:
    return states.groupBy(*MART_KEY).agg(F.sum("valor").cast("decimal(28,2)").alias("valor_total"))


def merged_counts(states: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exact distinct counts per mart key: bitmaps of one bucket are united, then their bits counted."""
    united = states.groupBy(*MART_KEY, "conjunto", "balde").agg(F.bitmap_or_agg("bits").alias("bits"))

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("conjunto") == name, F.bitmap_count("bits"))), F.lit(0)).alias(name)

    return united.groupBy(*MART_KEY).agg(*[of(name) for name in names])


def merged_totals(sum_states: DataFrame, set_states: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """valor_total, fornecedores_distintos and notas_distintas per mart key, from the states of any periods."""
    names = ("fornecedores_distintos", "notas_distintas")
    totals = merged_sums(sum_states)
    counts = merged_counts(set_states, names).withColumnsRenamed({name: f"_{name}" for name in MART_KEY})
    same = (
        (F.col("escopo") == F.col("_escopo")) & F.col("tipo").eqNullSafe(F.col("_tipo")) & F.col("ano").eqNullSafe(F.col("_ano"))
    )
    whole = totals.join(counts, same, "left").drop(*[f"_{name}" for name in MART_KEY]).fillna(0, list(names))
    return whole if years is None else whole.where(F.col("ano").isin(*years))


def by_type(totals: DataFrame) -> DataFrame:
    """Like ``marts.type_year_totals``."""
    return totals.where(F.col("escopo") == BY_TYPE).drop("escopo")


def by_year(totals: DataFrame) -> DataFrame:
    """Like ``marts.type_totals_by_year``."""
    return totals.where(F.col("escopo") == ALL_TYPES).drop("escopo", "tipo")


def code_sums(items: DataFrame, *keep: str) -> DataFrame:
    """Value per year, code and description: the additive state behind the item and keyword marts."""
    return items.groupBy(
        *keep, F.year("data_emissao").cast("bigint").alias("ano"), "codigo_ncm_sh",
        F.col("descricao_do_produto_servico").alias("descricao"),
    ).agg(F.sum("valor_total").alias("total"))


def merged_code_sums(states: DataFrame) -> DataFrame:
    return states.groupBy("ano", "codigo_ncm_sh", "descricao").agg(F.sum("total").cast("decimal(28,2)").alias("total"))


def restricted(items: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return items if years is None else items.filter(in_years(F.col("data_emissao"), years))
