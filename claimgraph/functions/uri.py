"""URIs in native columns: canonical forms, resolution, transports (H1-H3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cols import first_match

#: Hosts that serve content-addressed paths, and the gateways to which such URIs are sent, in order.
IPFS_HOSTS = ("ipfs.io", "gateway.ipfs.io", "dweb.link", "nftstorage.link", "w3s.link", "gateway.pinata.cloud", "cloudflare-ipfs.com")
IPFS_GATEWAYS = ("https://ipfs.io/ipfs/", "https://dweb.link/ipfs/", "https://nftstorage.link/ipfs/")
AR_GATEWAYS = ("https://arweave.net/",)
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_AUTHORITY = _SCHEME + r"//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def scheme(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), F.lit("")))


def host(c: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(c, _AUTHORITY, 1), F.lit("")))


def canonical_uri(c: Column) -> Column:
    """struct(uri, error): gateways become ipfs or ar, hosts are lower-cased, default ports and fragments dropped; paths keep their case.

    A path gateway is a known host with /ipfs/ in its path, a subdomain gateway a known host behind an identifier and
    .ipfs; other hosts stay what they are. Data URIs are kept whole if they hold JSON.
    """
    t = F.regexp_replace(F.trim(c), r"(?i)^arweave://", "ar://")
    # lambdas name what is computed once and used often
    steps = F.transform(F.transform(F.array(t), _split), _identity)
    return F.transform(steps, _canonical)[0]


def _split(t: Column) -> Column:
    query = F.nullif(F.regexp_extract(t, r"^[^?#]*(\?[^#]+)", 1), F.lit(""))
    return F.struct(
        t.alias("t"),
        scheme(t).alias("kind"),
        host(t).alias("name"),
        F.regexp_extract(t, _SCHEME + r"//[^/?#]*([^?#]*)", 1).alias("path"),
        F.coalesce(query, F.lit("")).alias("query"),
        F.regexp_extract(t, _AUTHORITY + r":(\d+)", 2).alias("port"),
    )


def _identity(x: Column) -> Column:
    """The parts with the content scheme and identifier that they name, if any."""
    name, path, kind = x["name"], x["path"], x["kind"]
    bare = lambda c: F.regexp_replace(c, "^/+", "")
    known = F.coalesce(name.isin(*IPFS_HOSTS) | name.endswith(".mypinata.cloud"), F.lit(False))
    by_path = F.nullif(bare(F.regexp_extract(path, "^.*?/ipfs/(.*)$", 1)), F.lit(""))
    cid = F.nullif(F.regexp_extract(name, r"^(.+)\.ipfs\.(?:" + "|".join(h.replace(".", r"\.") for h in IPFS_HOSTS) + ")$", 1), F.lit(""))
    again = F.concat(F.lit("ipfs/"), cid)
    rest = F.when(bare(path) == again, "").when(bare(path).startswith(F.concat(again, F.lit("/"))), F.substr(bare(path), F.length(again) + 2)).otherwise(bare(path))
    by_name = F.concat(cid, F.when(rest == "", "").otherwise(F.concat(F.lit("/"), rest)))
    ipfs = F.when(known, by_path).otherwise(by_name)
    ar = F.when(name == "arweave.net", F.nullif(bare(path), F.lit("")))
    own = first_match([(ipfs.isNotNull(), "ipfs"), (ar.isNotNull(), "ar"), (kind.isin("ipfs", "ipns", "ar"), kind)])
    body = F.coalesce(ipfs, ar, bare(F.regexp_extract(x["t"], _SCHEME + "([^?#]*)", 1)))
    return F.struct(x.alias("x"), own.alias("own"), body.alias("body"))


def _canonical(y: Column) -> Column:
    x, own = y["x"], y["own"]
    t, kind, port = x["t"], x["kind"], x["port"]
    usual = (port == "") | ((kind == "http") & (port == "80")) | ((kind == "https") & (port == "443"))
    body = F.when(own == "ipfs", F.regexp_replace(y["body"], "(?i)^ipfs(/+|$)", "")).otherwise(y["body"])
    web = F.concat(kind, F.lit("://"), x["name"], F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), F.when(x["path"] == "", "/").otherwise(x["path"]), x["query"])
    error = first_match(
        [
            (t.isNull() | (t == ""), "empty"),
            (kind.isNull(), "no_scheme"),
            (own.isNotNull() & (body == ""), "no_cid"),
            (own.isNotNull() | t.rlike("(?i)^data:(?:application/(?:ld\\+)?json|text/json)"), None),
            (~kind.isin("http", "https"), "scheme"),
            (t.rlike(_SCHEME + "//[^/?#]*@"), "credentials"),
            (x["name"].isNull(), "no_host"),
        ]
    )
    uri = first_match([(error.isNotNull(), None), (own.isNotNull(), F.concat(own, F.lit("://"), body, x["query"])), (kind == "data", t)], web)
    return F.struct(uri.alias("uri"), error.alias("error"))


def resolve_uri(base: Column, relative: Column) -> Column:
    """A relative reference against a base, dot segments removed."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/(?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    whole = first_match([(relative.startswith("/"), relative)], F.concat(folder, relative))
    path, query = F.regexp_extract(whole, r"^([^?#]*)", 1), F.regexp_extract(whole, r"^[^?#]*(\?[^#]*)", 1)
    parts = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done).when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(done)).otherwise(F.array_append(done, part)),
    )
    ends = F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise("")
    return first_match([(relative.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), relative), (relative.startswith("//"), F.concat(scheme(base), F.lit(":"), relative))], F.concat(root, F.array_join(parts, "/"), ends, query))


def transports(c: Column) -> Column:
    """Ordered HTTP candidates of one URI."""
    cid, ar = F.regexp_extract(c, r"^ipfs://(.+)$", 1), F.regexp_extract(c, r"^ar://(.+)$", 1)
    return F.when(cid != "", F.array(*(F.concat(F.lit(g), cid) for g in IPFS_GATEWAYS))).when(ar != "", F.array(*(F.concat(F.lit(g), ar) for g in AR_GATEWAYS))).otherwise(F.array(c))
