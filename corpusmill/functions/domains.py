"""Hosts and registrable domains of addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Public suffixes of two labels under which names are registered; any other last label is a suffix itself.
TWO_LABEL_SUFFIXES = (
    "co.uk org.uk ac.uk gov.uk me.uk net.uk ltd.uk plc.uk sch.uk nhs.uk com.au net.au org.au edu.au gov.au id.au co.nz net.nz org.nz ac.nz govt.nz "
    "co.jp ne.jp or.jp ac.jp go.jp ad.jp com.br net.br org.br gov.br edu.br co.za org.za ac.za gov.za com.cn net.cn org.cn gov.cn edu.cn ac.cn "
    "com.tw org.tw edu.tw gov.tw com.hk org.hk edu.hk gov.hk com.sg edu.sg gov.sg co.in net.in org.in ac.in gov.in co.kr or.kr ac.kr go.kr "
    "com.mx org.mx gob.mx edu.mx com.ar org.ar gob.ar edu.ar com.tr org.tr edu.tr gov.tr co.il org.il ac.il gov.il com.pl org.pl edu.pl gov.pl net.pl "
    "com.ua org.ua edu.ua gov.ua com.ru org.ru net.ru co.at or.at ac.at gv.at com.pt org.pt edu.pt gov.pt com.es org.es gob.es edu.es com.gr org.gr edu.gr"
).split()


def host(uri: Column) -> Column:
    """The host of an address; null for a broken one."""
    return F.try_parse_url(uri, F.lit("HOST"))


def is_name(name: Column) -> Column:
    """Whether a host is a domain name: labels of letters, digits and hyphens, the last one not a number."""
    return F.regexp_like(name, F.lit(r"^(?i)(?:[\p{L}\p{N}](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}])?\.)*[\p{L}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.?$"))


def registrable(name: Column) -> Column:
    """The domain that is registered under a public suffix; a suffix or a single label stands for itself; null for an
    IP address or another host that is no domain name."""
    low = F.regexp_replace(F.lower(name), r"\.$", "")
    labels = F.split(low, r"\.")
    n = F.size(labels)
    two = F.when(n >= 2, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1)))
    under = F.when(F.coalesce(two.isin(*TWO_LABEL_SUFFIXES), F.lit(False)), F.lit(3)).otherwise(F.lit(2))
    return F.when(is_name(name), F.when(n <= under, low).otherwise(F.array_join(F.slice(labels, n - under + 1, under), ".")))
