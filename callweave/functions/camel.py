"""Normalisation of called numbers for call control (version 3.2 of the rules).

Sixteen rules, the first that matches wins; all of them are column expressions.
Inputs are the columns service_key, event_type, vlr, ton, called_number,
redirection_present, original_called_number and sccp_clg_pa.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the rules.
HOME = "60"
SPECIAL_ROAMING_VLR = "60180000000000"
MISSED_CALL_PREFIXES = ["6018140", "60181334", "60181335"]
S8HR_GATEWAYS = ["60181000366", "60181000031"]
SUBSCRIBER, UNKNOWN, INTERNATIONAL = 1, 2, 4  # nature of address
TON_UNKNOWN, TON_INTERNATIONAL, TON_SUBSCRIBER = 0, 1, 4
FOREIGN_MARK = "C35"

FIELDS = ["rule", "action", "release_cause", "connect_number", "noa", "charging_number", "on_net", "is_charged", "is_roaming", "is_s8hr", "is_cs", "is_idd"]


def _result(rule: int, connect: Column | None = None, noa: Column | int | None = None, charging: Column | None = None, release: str | None = None, **flags: Column | bool) -> Column:
    text = F.lit(None).cast("string")
    given = {
        "rule": F.lit(rule),
        "action": F.lit("RELEASE" if release else "CONTINUE" if rule in (1, 14) else "CONNECT"),
        "release_cause": F.lit(release) if release else text,
        "connect_number": text if connect is None else connect,
        "noa": F.lit(None).cast("int") if noa is None else noa if isinstance(noa, Column) else F.lit(noa),
        "charging_number": text if charging is None else charging,
    }
    for name in FIELDS[6:]:
        value = flags.get(name, name == "is_charged")
        given[name] = F.coalesce(value, F.lit(False)) if isinstance(value, Column) else F.lit(value)
    return F.struct(*[c.alias(n) for n, c in given.items()])


def camel_result() -> Column:
    called, vlr, ton = F.col("called_number"), F.col("vlr"), F.col("ton")
    mo = F.col("service_key") == 82
    redirected = mo & F.coalesce(F.col("redirection_present"), F.lit(False))
    away = (vlr == SPECIAL_ROAMING_VLR) | ~vlr.startswith(HOME)
    home, roaming = mo & ~away, mo & away
    on_net = called.rlike("^208.")
    without_four, without_two, without_one = (F.substring(called, n, 1 << 20) for n in (5, 3, 2))
    local = F.concat(F.lit(HOME), without_four)
    missed = called.startswith(MISSED_CALL_PREFIXES[0])
    for prefix in MISSED_CALL_PREFIXES[1:]:
        missed = missed | called.startswith(prefix)
    gateway = F.coalesce(F.col("sccp_clg_pa").isin(S8HR_GATEWAYS), F.lit(False))
    noa_by_prefix = F.when(called.startswith("20"), SUBSCRIBER).when(called.startswith(HOME), INTERNATIONAL).otherwise(UNKNOWN)

    def begins(prefix: str) -> Column:
        return called.startswith(prefix)

    rules = [
        (redirected & missed, _result(1, on_net=True, is_charged=False)),
        (redirected, _result(2, called, noa_by_prefix, F.coalesce("original_called_number", called), on_net=on_net)),
        (home & (ton == TON_SUBSCRIBER) & begins("20"), _result(3, called, SUBSCRIBER, local, on_net=on_net)),
        (home & (ton == TON_INTERNATIONAL) & begins(HOME), _result(4, called, INTERNATIONAL, called)),
        (home & (ton == TON_INTERNATIONAL), _result(5, F.concat(F.lit(FOREIGN_MARK), called), UNKNOWN, called, is_idd=True)),
        (home & (ton == TON_UNKNOWN) & begins("0060"), _result(6, without_two, INTERNATIONAL, without_two)),
        (home & (ton == TON_UNKNOWN) & begins("00"), _result(7, F.concat(F.lit(FOREIGN_MARK), without_two), UNKNOWN, without_two, is_idd=True)),
        (home & (ton == TON_UNKNOWN) & begins("0"), _result(8, F.concat(F.lit(HOME), without_one), INTERNATIONAL, F.concat(F.lit(HOME), without_one))),
        (home & (ton == TON_UNKNOWN), _result(9, called, UNKNOWN, F.concat(F.lit(HOME), called))),
        (roaming & (ton == TON_SUBSCRIBER) & begins("20") & gateway, _result(10, called, SUBSCRIBER, local, is_roaming=True, is_s8hr=True)),
        (roaming & (ton == TON_SUBSCRIBER) & begins("20"), _result(11, without_four, INTERNATIONAL, local, is_roaming=True, is_cs=True)),
        (roaming & (ton == TON_INTERNATIONAL), _result(12, called, INTERNATIONAL, called, is_roaming=True, is_cs=True, is_idd=~begins(HOME))),
        (roaming & (ton == TON_UNKNOWN) & begins("00"), _result(13, without_two, INTERNATIONAL, without_two, is_roaming=True, is_cs=True, is_idd=~begins("0060"))),
        ((F.col("service_key") == 83) & (F.col("event_type") == "termAttemptAuthorized"), _result(14)),
        (mo, _result(15, release="INVALID_NUMBER", is_roaming=away)),
    ]
    out = F.when(*rules[0])
    for condition, result in rules[1:]:
        out = out.when(condition, result)
    return out.otherwise(_result(16, release="INVALID_SERVICE_KEY"))


def normalize(calls: DataFrame) -> DataFrame:
    """``calls`` with the columns of FIELDS; a null VLR or an unknown form is released."""
    return calls.withColumn("camel", camel_result()).select(*calls.columns, "camel.*")
