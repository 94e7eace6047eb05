"""Joins of invoice items with code, prefix, chain, keyword and supplier tables.

No join here forces a broadcast beyond Spark's own limit. Spark compares the size of the mapping side with
spark.sql.autoBroadcastJoinThreshold when it plans and, under adaptive execution, again with the
size measured at run time (keyword tables are measured here); a larger mapping is shuffled, and adaptive execution splits the
partitions of hot codes. Every condition is an equality, so neither plan is a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoice_lake.functions.codes import taxpayer_root
from invoice_lake.functions.periods import in_years as _in_years
from invoice_lake.functions.text import found_keywords
from invoice_lake.schemas import ITEM_KEY

CHAIN_COLUMNS = (
    "codigo_cadeia", "cadeia", "missao", "nome_missao", "cnae", "desc_cnae", "criterio", "icp",
    "missoes", "secao_cnae", "sh_correspondente",
)


def code_map(mapping: DataFrame, code: str = "ncm", label: str = "tipo") -> DataFrame:
    """Distinct (code, trimmed label) pairs of a mapping table."""
    return mapping.select(F.col(code), F.trim(F.col(label)).alias(label)).distinct()


def join_codes(
    items: DataFrame, mapping: DataFrame, how: str = "inner", code: str = "codigo_ncm_sh"
) -> DataFrame:
    """Items with the type of their exact code; ``how='left'`` keeps unmapped items, type NULL."""
    return items.join(code_map(mapping).withColumnRenamed("ncm", code), code, how)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Spark keeps the first row per task before the shuffle, so a key with very
    many copies reaches its reducer as one row per map task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def match_any_prefix(
    codes: DataFrame, mapping: DataFrame, code: str, prefix: str, lengths: Sequence[int] = (8, 6, 4)
) -> DataFrame:
    """Distinct codes with the mapping rows whose prefix equals the code cut to one of ``lengths``.

    The codes are made distinct before they are matched: there are at most some thousands of them,
    however many items there are.
    """
    cuts = F.array_distinct(F.array(*[F.substring(code, 1, n) for n in lengths]))
    return (
        codes.select(code).distinct()
        .select(code, F.explode(cuts).alias(prefix))
        .join(mapping, prefix)
    )


def join_any_prefix(
    items: DataFrame,
    mapping: DataFrame,
    code: str = "codigo_ncm_sh",
    prefix: str = "ncm_cod",
    lengths: Sequence[int] = (8, 6, 4),
) -> DataFrame:
    """Left join on code = prefix OR left(code, 6) = prefix OR left(code, 4) = prefix.

    Reports sum the items per code first and join the sums.
    """
    return items.join(match_any_prefix(items, mapping, code, prefix, lengths), code, "left")


def match_chains(codes: DataFrame, prefixes: DataFrame, code: str = "codigo_ncm_sh") -> DataFrame:
    """Distinct codes with the prefixes that they begin with, of any length that the mapping has.

    Only distinct codes are cut, of which there are some thousands, however many items there are, and to the mapping's lengths only.
    """
    known = prefixes.select(F.collect_set(F.col("tamanho_prefixo").cast("int"))).scalar()
    sized = codes.filter(F.length(code) > 0).select(code).distinct().select(code, F.explode(known).alias("tamanho_prefixo"))
    cuts = sized.where(F.col("tamanho_prefixo").between(1, F.length(code))).withColumn(
        "prefixo_sh", F.substring(F.col(code), F.lit(1), F.col("tamanho_prefixo"))
    )
    return cuts.join(prefixes, ["prefixo_sh", "tamanho_prefixo"])


#: Number of a row's chain values; ``ChainLinks.chains`` says which values it stands for.
LINK, LINKS = "_elo", "_elos"


@dataclass(frozen=True)
class ChainLinks:
    """Items with their production chains, the chains as numbers.

    ``alone`` has the items whose key no other row has, their chains as an array; ``repeated`` has a row per chain of the others.
    ``chains`` has each ``LINK`` with its values; sums per number meet them at the end.
    """

    alone: DataFrame
    repeated: DataFrame
    chains: DataFrame

    @property
    def items(self) -> DataFrame:
        """A row per item and chain: the item's columns, tamanho_prefixo, the carried chain columns and ``LINK``."""
        return _per_chain(self.alone).unionByName(self.repeated)

    @property
    def once(self) -> DataFrame:
        """A row per item that has a chain: of the copies of a key, the one that comes first by columns in the order of their names.

        That order ends with codigo_cadeia: an item stands once per chain, so what is named after it decides nothing.
        """
        names = sorted(set(self.repeated.columns) - set(ITEM_KEY) - {LINK})
        names = names[: names.index("codigo_cadeia") + 1]
        first = first_per(self.repeated, ITEM_KEY, [F.asc_nulls_last(c) for c in names])
        whole = self.alone.drop(LINKS)
        return whole.unionByName(first.select(*whole.columns))

    def named(self, sums: DataFrame) -> DataFrame:
        """Sums per ``LINK`` with the chain's values."""
        return sums.join(self.chains, LINK).drop(LINK)


def _per_chain(alone: DataFrame) -> DataFrame:
    return alone.select(*[c for c in alone.columns if c != LINKS], F.inline(LINKS))


def _prefix_rows(chain_map: DataFrame, dedup: Sequence[str]) -> DataFrame:
    """One mapping row per prefix and ``dedup``. The choice among several is arbitrary; make it repeatable."""
    attributes = [c for c in CHAIN_COLUMNS if c in chain_map.columns]
    rows = chain_map.select("prefixo_sh", F.col("tamanho_prefixo").cast("int"), *attributes)
    return first_per(rows, ["prefixo_sh", "tamanho_prefixo", *dedup], [F.asc_nulls_last(c) for c in sorted(attributes)])


def _linked(
    items: DataFrame, rows: DataFrame, dedup: Sequence[str], carried: Sequence[str], code: str = "codigo_ncm_sh"
) -> tuple[DataFrame, DataFrame]:
    """``items`` once per value of ``dedup``, with the longest prefix that their code meets and its ``carried`` columns.

    The first frame has the items whose key no other row has, with an array of chains, the second a row per chain of the others.

    Prefixes are resolved per distinct code. The items are dealt by item key once, before they have chains, and both frames read
    that shuffle: ``_lugar`` keeps all columns in it, whatever a report drops later. Behind it an item needs only the columns of
    its report to meet its chains by code. Only copies of an item key are compared, others stand once anyhow.
    """
    sized = [code, "_tamanho"]  # with the length, the links are dealt by code anew for the join, which can split a hot code then
    found = match_chains(items, rows.select("prefixo_sh", "tamanho_prefixo", *dict.fromkeys((*dedup, *carried))), code)
    found = found.withColumn("_tamanho", F.length(code)).repartition(*sized)
    found = first_per(found, [*sized, *dedup], [F.desc("tamanho_prefixo"), "prefixo_sh"])
    link = F.struct("tamanho_prefixo", *dict.fromkeys((*dedup, *carried)))
    links = found.groupBy(*sized).agg(F.collect_list(link).alias(LINKS)).drop("_tamanho")

    rest = [F.asc_nulls_last(c) for c in sorted(set(items.columns) - set(ITEM_KEY))]
    key = Window.partitionBy(*ITEM_KEY)
    dealt = items.repartition(*ITEM_KEY).withColumns(
        {"_lugar": F.row_number().over(key.orderBy(*rest)), "_copias": F.count("*").over(key)})
    alone, several = (dealt.where(copies).drop("_copias") for copies in ("_copias = 1 and _lugar > 0", "_copias > 1"))
    # No two copies have one place: the columns after it decide nothing, and keep the shuffle the same for all that a report reads.
    longest = [F.desc("tamanho_prefixo"), F.expr(f"left(`{code}`, tamanho_prefixo)"), F.asc("_lugar"), *rest, *carried]
    repeated = first_per(_per_chain(several.join(links, code)), [*ITEM_KEY, *dedup], longest)
    return alone.drop("_lugar").join(links, code), repeated.drop("_lugar")


def chain_links(
    items: DataFrame,
    chain_map: DataFrame,
    years: Sequence[int],
    dedup: Sequence[str] = ("codigo_cadeia",),
    by: Sequence[str] = ("codigo_cadeia",),
    carried: Sequence[str] = (),
) -> ChainLinks:
    """Like ``chain_items``, with a number for the chain columns ``by``, to which ``dedup`` belongs; ``carried`` stay beside it."""
    rows = _prefix_rows(chain_map, dedup)
    # Two values with one number would be summed as one; that they never share one is checked where the numbers are named.
    rows = rows.withColumn(LINK, F.xxhash64(F.to_json(F.struct(*by))))
    values = rows.groupBy(LINK).agg(F.min(F.struct(*by)).alias("_valores"), F.max(F.struct(*by)).alias("_outros"))
    clash = F.raise_error(F.lit("two chains have one number"))
    chains = values.select(LINK, F.when(F.col("_valores").eqNullSafe(F.col("_outros")), F.col("_valores")).otherwise(clash).alias("_v"))
    in_years = items.filter(_in_years(F.col("data_emissao"), years))
    return ChainLinks(*_linked(in_years, rows, dedup, (LINK, *carried)), chains.select(LINK, "_v.*"))


def chain_items(
    items: DataFrame,
    chain_map: DataFrame,
    years: Sequence[int],
    dedup: Sequence[str] = ("codigo_cadeia",),
) -> DataFrame:
    """Items of the given years with their production chains, each item at most once per chain.

    A code that meets a chain through several prefixes keeps the longest one. ``dedup`` names the
    chain columns within which an item may stand once. Reports by CNAE need ("codigo_cadeia",
    "cnae"), or an item of a chain would count for one of its CNAEs only. Reports that need no
    more than sums per chain take ``chain_links``.

    The items pass the shuffles with the prefix they matched; the chain's attributes join afterwards.
    """
    rows = _prefix_rows(chain_map, dedup)
    alone, repeated = _linked(items.filter(_in_years(F.col("data_emissao"), years)), rows, dedup, ())
    once = _per_chain(alone).unionByName(repeated).withColumn("prefixo_sh", F.expr("left(codigo_ncm_sh, tamanho_prefixo)"))
    # An unset chain column such as the CNAE is a value of its own here.
    keys = ["prefixo_sh", "tamanho_prefixo", *dedup]
    renamed = rows.withColumnsRenamed({name: f"_map_{name}" for name in keys})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_map_{name}")) for name in keys])
    return once.join(renamed, same).drop(*[f"_map_{name}" for name in keys])


def join_keywords(
    df: DataFrame,
    text: Column,
    keywords: Sequence[str],
    needles: Sequence[str] | None = None,
    out: str = "palavra_chave",
) -> DataFrame:
    """Left join on text LIKE '%needle%': one row per keyword found, one with NULL if none is.

    The keyword list is configuration written by hand, so it is part of the expression: one scan,
    no pairing of rows with keywords. LIKE wildcards in a needle are refused, not taken literally.
    """
    needles = list(needles if needles is not None else keywords)
    for needle in needles:
        if "%" in needle or "_" in needle:
            raise ValueError(f"keyword with a LIKE wildcard: {needle!r}")
    return df.withColumn(out, F.explode_outer(found_keywords(text, keywords, needles)))


def _runs(text: Column, lengths: Sequence[int]) -> Column:
    """Distinct runs of the given numbers of characters. The text is cut to characters once, so that long ones cost no more each."""
    def of(chars: Column) -> Column:
        def runs(k: int) -> Column:
            whole = F.transform(F.sequence(F.lit(0), F.size(chars) - k), lambda i: F.concat(*[F.get(chars, i + j) for j in range(k)]))
            return F.when(F.size(chars) >= k, whole).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.concat(*[runs(k) for k in lengths]))

    return F.transform(F.array(F.split(text, "")), of)[0]


#: What separates words in texts; a needle without it lies within one word.
_BLANKS = r"[ \t\n\r]+"


def match_keyword_table(texts: DataFrame, text: str, keywords: DataFrame, needle: str, k: int = 3) -> DataFrame:
    """(text_id, needle) of every needle that a text contains, for a keyword table of any size; text_id is the text's md5, 16 bytes.

    A needle without blanks lies within a word, so it is looked up in the distinct words of all texts, and the texts meet their
    words: the work grows with the words that differ, not with the characters. The others are looked up in the texts themselves.
    A word's needles stay an array until they have reached the text, where those of several words are made distinct: one shuffle
    of a row per text and word, and the result is dealt by text.
    Needles are taken literally; empty and null ones find nothing.
    """
    named = texts.where(F.col(text).isNotNull()).select(text_id(F.col(text)).alias("text_id"), F.col(text).alias("_texto"))
    needles = keywords.select(F.col(needle).alias("_agulha")).where("_agulha <> ''").distinct()
    blank = F.col("_agulha").rlike(_BLANKS)
    pieces = F.array_distinct(F.split("_texto", _BLANKS))
    words = named.select("text_id", F.explode(pieces).alias("_palavra")).where("_palavra <> ''")
    per_word = _met(words.select("_palavra").distinct(), "_palavra", needles.where(~blank), k).where(
        F.contains("_palavra", "_agulha")).groupBy("_palavra").agg(F.collect_list("_agulha").alias("_agulhas"))
    within = words.join(per_word, "_palavra").select("text_id", "_agulhas")
    once = named.groupBy("text_id").agg(F.first("_texto").alias("_texto"))
    # A text passes one shuffle with all needles that it may contain, and checks them in one expression.
    met = _met(once, "_texto", needles.where(blank), k, "text_id").groupBy("text_id").agg(F.collect_list("_agulha").alias("_agulhas"))
    across = once.join(met, "text_id").select("text_id", F.filter("_agulhas", lambda n: F.contains("_texto", n)).alias("_agulhas"))
    dealt = within.unionByName(across).repartition("text_id")
    return dealt.select("text_id", F.explode("_agulhas").alias(needle)).distinct()


def text_id(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _met(texts: DataFrame, text: str, needles: DataFrame, k: int, key: str | None = None) -> DataFrame:
    """(key, _agulha) of the distinct texts and the needles that they may contain; the text is the key if there is no other.

    Each needle is looked up by the rarest of its runs of ``k`` characters (by the whole of it, if it has fewer): texts and
    needles meet in an equality on that run.
    """
    key = key or text
    sized = needles.withColumn("_k", F.least(F.char_length("_agulha"), F.lit(k)))
    per_length = sized.groupBy("_k").agg(F.sum(F.octet_length("_agulha") + 48).alias("bytes")).collect()  # at most k rows
    lengths = sorted(row["_k"] for row in per_length)
    if not lengths:
        return texts.select(key, F.lit(None).cast("string").alias("_agulha")).limit(0)
    per_needle = sized.select("_agulha", F.explode(_runs(F.col("_agulha"), lengths)).alias("_trecho"), "_k").where(
        F.char_length("_trecho") == F.col("_k")).select("_agulha", "_trecho")
    index = texts.select(key, F.explode(_runs(F.col(text), lengths)).alias("_trecho")).join(
        per_needle.select("_trecho").distinct(), "_trecho")
    held = index.groupBy("_trecho").agg(F.count("*").alias("_textos"))
    rarest = per_needle.join(held, "_trecho", "left").groupBy("_agulha").agg(
        F.min(F.struct(F.coalesce("_textos", F.lit(0)).alias("n"), "_trecho")).alias("_r")).where("_r.n > 0").select("_agulha", "_r._trecho")
    # Spark can't tell how many rows these are, and would deal the whole index by run; they are a row per needle at most.
    if sum(row["bytes"] for row in per_length) <= _broadcast_bytes(texts):
        rarest = F.broadcast(rarest)
    return index.join(rarest, "_trecho").select(key, "_agulha")


def _broadcast_bytes(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def join_keyword_table(df: DataFrame, text: str, keywords: DataFrame, needle: str = "agulha", k: int = 3) -> DataFrame:
    """``df`` with a row per keyword of ``keywords`` (needle and any columns) that its text contains; one with NULLs if none is.

    Like LEFT JOIN ON text LIKE '%needle%' with literal needles. ``df`` has none of the columns of ``keywords``.
    """
    found = match_keyword_table(df, text, keywords, needle, k).join(keywords, needle)
    return df.withColumn("text_id", text_id(F.col(text))).join(found, "text_id", "left").drop("text_id")


def join_supplier_presence(
    invoices: DataFrame, presence: DataFrame, tax_id: str = "cpf_cnpj_emitente"
) -> DataFrame:
    """Left join on the eight-character company root of the issuer."""
    rooted = invoices.withColumn("cnpj_basico", taxpayer_root(F.col(tax_id)))
    flagged = presence.withColumn("_presente", F.lit(True))
    joined = rooted.join(flagged, "cnpj_basico", "left")
    return joined.withColumn("cnpj_disponivel", F.col("_presente").isNotNull()).drop("_presente")
