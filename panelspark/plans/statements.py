"""Mapping of free-form statement headers to measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised header candidates, in order of preference.
BANK_CANDIDATES = {
    "interest_income": ["przychodyztytuloodsetektys", "przychodyztytuoodsetektys", "przychodyztytuuodsetektys",
                        "przychodyztytuloodsetek", "przychodyztytuuodsetek"],
    "fee_income": ["przychodyztytuloprowizjitys", "przychodyztytuuprowizjitys", "przychodyztytuloprowizji",
                   "przychodyztytuuprowizji"],
    "banking_result": ["wynikdzialalnoscibankowejtys", "wyniknadzialnoscibankowejtys",
                       "wyniknadziaalnoscibankowejtys", "wyniknadzia", "wynikdzialalnoscibankowej"],
    "gross_profit": ["zyskstratabruttotys", "zyskstratabrutto"],
    "net_profit": ["zyskstratanettotys", "zyskstratanetto"],
    "amortization": ["amortyzacjatys", "amortyzacja"],
    "assets": ["aktywatys", "aktywa"],
    "equity": ["kapitalwlasnytys", "kapitalwlasny", "kapitawasnytys", "kapitawasny", "kapita", "kapitaw"],
    "shares_thousands": ["liczbaakcjitysszt", "liczbaakcjitysszt.", "liczbaakcji"],
    "bvps": ["wartoscksiegowanaakcjez", "wartoscksiegowanaakcjezl", "wartoscksiegowanaakcje"],
    "eps": ["zysknaakcjez", "zysknaakcjezl", "zysknaakcje"],
}
REVENUE = ["przychodynettozesprzedazytys", "przychodyzesprzedazytys", "przychodytys", "przychodynetttys",
           "obrotytys", "przychodyogolemtys", "wynikdzialalnoscibankowejtys", "skladkanaudzialewlasnymtys",
           "skladkabruttotys"]
INSURANCE_PREMIUM, INSURANCE_INVESTMENT = ["skladkanaudzialewlasnymtys"], ["przychodyzlokattys"]
BANK_RESULT = ["wyniknadzialalnoscibankowejtys", "wynikdzialalnoscibankowejtys", "wyniknadzialalnoscbankowejtys"]
BANK_INTEREST = ["przychodyztytuloodsetektys", "przychodyztytuoodsetektys"]
BANK_FEES = ["przychodyztytuloprowizjitys"]
OPERATING = ["zyskstratazdziaalopertys", "zyskoperacyjnytys", "wynikzdzialalnoscioperacyjnejtys", "ebittys",
             "wyniktechniczny"]
TECHNICAL = ["wyniktechniczny"]
GROSS, NET = ["zyskstratabruttotys"], ["zyskstratanettotys", "zyskstratanetto"]
EBITDA, EBIT = ["ebitdatys", "ebitda"], ["ebittys", "zyskoperacyjnytys", "zyskstratazdziaalopertys"]
AMORTISATION = ["amortyzacjatys", "amortyzacja"]
OPTIONAL = {
    "assets": ["aktywatys", "aktywa"],
    "equity": ["kapitalwlasnytys", "kapitalwlasnytys*", "kapitalwlasny"],
    "shares": ["liczbaakcjitysszt", "liczbaakcjitysszt.", "liczbaakcji"],
    "eps": ["zysknaakcjez", "zysknaakcjezl", "zysknaakcje(zl)"],
    "bvps": ["wartoscksiegowanaakcjez", "wartoscksiegowanaakcjezl"],
}
AUDITED = ["raportzbadanyprzezaudytora"]
BANK_SECTOR, INSURANCE_SECTOR = 7, 22


def preference(header: Column, candidates: Sequence[str], exact: bool = True, prefix: bool = False) -> Column:
    """Rank of a header for a candidate list, NULL when it matches none.

    Exact matches come before prefix matches; each follows the list order.
    """
    rank = None
    tests = [header == c for c in candidates] if exact else []
    tests += [header.startswith(c) for c in candidates] if prefix else []
    for i, test in enumerate(tests):
        rank = F.when(test, i) if rank is None else rank.when(test, i)
    return rank


def pick(candidates: Sequence[str], exact: bool = True, prefix: bool = False,
         header: str = "header", value: str = "value", place: str = "header") -> Column:
    """Aggregate: struct of the value under the preferred header, NULL when no header matches.

    Headers with the same prefix are told apart by ``place``, the order of the columns where it is known.
    """
    rank = preference(F.col(header), candidates, exact, prefix)
    return F.min_by(F.struct(F.col(value).alias("v")), F.when(rank.isNotNull(), F.struct(rank, F.col(place), F.col(header))))


def _place(rows: DataFrame) -> str:
    return "nth" if "nth" in rows.columns else "header"


def map_bank(rows: DataFrame, keys: Sequence[str] = ("company_id", "date")) -> DataFrame:
    """Eleven bank measures from normalised statement rows."""
    wide = rows.groupBy(*keys).agg(*[pick(c, prefix=True, place=_place(rows)).alias(m) for m, c in BANK_CANDIDATES.items()])
    return wide.select(*keys, *[F.col(f"{m}.v").alias(m) for m in BANK_CANDIDATES])


def map_sector(rows: DataFrame, companies: DataFrame) -> DataFrame:
    """Revenue, profits and EBITDA by the rules of the company's sector, with optional extras.

    The audit note is text; it is NULL when the rows carry no cell text.
    """
    picks = {"rev": pick(REVENUE), "prem": pick(INSURANCE_PREMIUM), "inv": pick(INSURANCE_INVESTMENT),
             "bank": pick(BANK_RESULT), "int": pick(BANK_INTEREST), "fee": pick(BANK_FEES),
             "op": pick(OPERATING, exact=False, prefix=True, place=_place(rows)),
             "tech": pick(TECHNICAL, exact=False, prefix=True, place=_place(rows)),
             "gross": pick(GROSS), "net": pick(NET), "ebitda": pick(EBITDA), "ebit": pick(EBIT),
             "amort": pick(AMORTISATION), **({"audited": pick(AUDITED, exact=False, prefix=True, value="text", place=_place(rows))}
                                             if "text" in rows.columns else {}), **{m: pick(c) for m, c in OPTIONAL.items()}}
    wide = rows.groupBy("company_id", "date").agg(*[c.alias(f"_{n}") for n, c in picks.items()])
    sector = companies.select(F.col("id").alias("company_id"), "sector_id")
    wide = wide.join(sector, "company_id", "left")

    def has(n: str) -> Column:
        return F.col(f"_{n}").isNotNull()

    def val(n: str) -> Column:
        return F.col(f"_{n}.v")

    def or_zero(n: str) -> Column:
        return F.coalesce(val(n), F.lit(0.0))

    bank, insurer = F.col("sector_id") == BANK_SECTOR, F.col("sector_id") == INSURANCE_SECTOR
    revenue = (F.when(insurer & (has("prem") | has("inv")), or_zero("prem") + or_zero("inv"))
               .when(bank & has("bank"), val("bank"))
               .when(bank & has("fee"), or_zero("int") + or_zero("fee"))
               .when(bank, val("int")).otherwise(val("rev")))
    operating = F.when(insurer, val("tech")).when(~F.coalesce(bank, F.lit(False)), val("op"))
    financial = F.coalesce(bank | insurer, F.lit(False))
    ebitda = F.when(~financial & has("ebitda"), val("ebitda")).when(~financial, val("ebit") + val("amort"))
    return wide.select("company_id", "date", revenue.alias("revenue"), operating.alias("operating_profit"),
                       val("gross").alias("gross_profit"), val("net").alias("net_profit"),
                       ebitda.alias("ebitda"), *[val(m).alias(m) for m in OPTIONAL],
                       (val("audited") if "text" in rows.columns else F.lit(None).cast("string")).alias("audited"))
