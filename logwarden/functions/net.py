"""Address expressions."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules

OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"^{OCTET}(\.{OCTET}){{3}}$"


def is_ipv4(ip: Column) -> Column:
    """Four octets of 0..255 without leading zeros."""
    return F.coalesce(ip.rlike(IPV4), F.lit(False))


def ip_num(ip: Column) -> Column:
    """IPv4 text as a number, null if it is not a valid address."""
    part = F.split(ip, r"\.")
    number = sum(
        F.try_element_at(part, F.lit(i + 1)).cast("bigint") * (256 ** (3 - i)) for i in range(4)
    )
    return F.when(is_ipv4(ip), number)


def block_range(cidr: str) -> tuple[int, int]:
    net = ipaddress.ip_network(cidr)
    return int(net.network_address), int(net.broadcast_address)


def in_private_block(number: Column, blocks=rules.PRIVATE_BLOCKS, public=rules.PUBLIC_EXCEPTIONS) -> Column:
    """Whether an address number lies in a private or reserved block; false for null."""

    def within(cidrs: list[str]) -> Column:
        ranges = F.array(*[F.struct(F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high"))
                           for low, high in map(block_range, cidrs)])
        return F.exists(ranges, lambda r: number.between(r["low"], r["high"]))

    return F.coalesce(within(blocks) & ~within(public), F.lit(False))


def with_private_flag(df: DataFrame, ip: str, flag: str = "is_private_ip") -> DataFrame:
    """Adds ``flag``; the number is a column of its own, so it is worked out once per row."""
    return df.withColumn("_num", ip_num(F.col(ip))).withColumn(flag, in_private_block(F.col("_num"))).drop("_num")


def first_ip(text: Column) -> Column:
    """First dotted quad of a text, null if there is none."""
    return F.nullif(F.regexp_extract(text, rules.DOTTED_QUAD, 1), F.lit(""))


def indicator_type(value: Column) -> Column:
    """domain if it has a dot and is not digits and dots only; hash by length; else ip."""
    digits_only = F.replace(value, F.lit("."), F.lit("")).rlike(r"^\d+$")
    return (
        F.when(value.contains(".") & ~digits_only, "domain")
        .when(F.length(value).isin(32, 40, 64), "hash")
        .otherwise("ip")
    )


def private_place_index(ip: Column, n: int = len(rules.PRIVATE_PLACES)) -> Column:
    """md5(ip) mod 5 without big integers: 16 = 1 (mod 5), so the hex digits can be summed."""
    if n != 5:
        raise ValueError("the digit-sum identity holds for five places")
    digits = F.split(F.md5(ip), "")
    total = F.aggregate(
        digits,
        F.lit(0).cast("bigint"),
        lambda acc, d: acc + F.when(d == "", F.lit(0)).otherwise(F.conv(d, 16, 10).cast("bigint")),
    )
    return total % n
