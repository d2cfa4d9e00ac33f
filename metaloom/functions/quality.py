"""Rules read off one row: dead links, kinds of distribution, probe verdicts."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaloom.constants import (DEAD_HOST, DEAD_PHRASES, FILE_EXTENSION, GEO_ADDRESS,
                                GEO_EXTENSION, GEO_FORMATS, GONE, HTTP_ERRORS, PXWEB_ADDRESS,
                                TOO_MANY_REQUESTS)
from metaloom.functions.literals import literal_map
from metaloom.functions.text import casefold, let, strip
from metaloom.functions.uris import as_column, host_of, path_of, scheme_of


def dead_reasons():
    """The whole messages that mean gone."""
    phrases = [phrase for several in HTTP_ERRORS.values() for phrase in several]
    return sorted({p.casefold() for p in phrases} | {str(code) for code in HTTP_ERRORS}
                  | set(DEAD_PHRASES))


def is_dead(reason) -> Column:
    """Whether the reason given for a broken link says the file is gone. An allow-list: a
    message nobody has seen before is not a death."""
    message = casefold(strip(reason))
    return F.coalesce(message.isin(dead_reasons()) | F.contains(message, F.lit(DEAD_HOST)),
                      F.lit(False))


def kind_by_address(url) -> Column:
    """The kind an address gives away by its shape, or null. Host and path are read only where the
    address holds what they are asked for."""
    def shape(lowered):
        def holds(*parts):
            return reduce(or_, [F.contains(lowered, F.lit(part)) for part in parts])

        host, path = host_of(lowered), path_of(lowered)
        return (F.when(holds("/rowstore/dataset/"), "rowstore")
                .when((holds("/dataset/") & lowered.rlike("/dataset/[^/]+/resource/")) | holds("/api/3/action/"), "ckan")
                .when(holds("/explore/dataset/", "/api/explore/", "/api/records/"), "huwise")
                .when(lowered.rlike(GEO_ADDRESS) | (lowered.rlike(GEO_EXTENSION.removesuffix("$")) & path.rlike(GEO_EXTENSION)),
                      "geodata")
                .when((holds("api.scb.se") & (host == "api.scb.se")) | lowered.rlike(PXWEB_ADDRESS), "pxweb")
                .when(holds("kolada.se") & ((host == "kolada.se") | F.endswith(host, F.lit(".kolada.se"))), "kolada")
                .when(holds("doi.org") & host.isin("doi.org", "dx.doi.org"), "doi"))

    return let(F.lower(as_column(url)), shape)


def kind_of(format, download_url, access_url, has_service) -> Column:
    """What a distribution is, from its metadata, strongest signal first."""
    fmt = F.coalesce(as_column(format), F.lit(""))
    download = F.coalesce(as_column(download_url), F.lit(""))
    access = F.coalesce(as_column(access_url), F.lit(""))
    html = fmt == "html"

    def of_download(shape):
        return (F.when(shape.isin("geodata", "rowstore", "huwise"), shape)
                .when(html & ~path_of(download).rlike(FILE_EXTENSION), "web_page")
                .otherwise("file"))

    def of_access(shape):
        return (F.when(shape.isNotNull(), shape)
                .when(html, "web_page")
                .when((fmt != "") | path_of(access).rlike(FILE_EXTENSION), "file"))

    return (F.when(fmt.isin(GEO_FORMATS), "geodata")
            .when(download != "", let(kind_by_address(download), of_download))
            .otherwise(F.coalesce(
                F.when(access != "", let(kind_by_address(access), of_access)),
                F.when(F.coalesce(has_service, F.lit(False)), F.lit("api")),
                F.lit("unknown"))))


def status_phrase(status) -> Column:
    """The current standard phrase of an HTTP error status, else its number."""
    phrases = literal_map({code: several[-1] for code, several in HTTP_ERRORS.items()})
    code = status.cast("string")
    return F.coalesce(F.try_element_at(phrases, code), code)


def probe_verdict(url, head_status, get_status, head_final, baseline_final, error, host_known,
                  insecure_head_status=None, insecure_get_status=None,
                  insecure_final=None) -> Column:
    """The verdict of one recorded probe as struct(status, reason, invalid_cert, answered).

    `answered` is true for an answer, false for silence, and null where the probe says nothing
    about the host: no such host, or not an http address.
    """
    null_int, null_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    certificate = F.coalesce(error == "certificate", F.lit(False))
    second_head = null_int if insecure_head_status is None else insecure_head_status
    second_get = null_int if insecure_get_status is None else insecure_get_status
    second_final = null_text if insecure_final is None else insecure_final
    retried = certificate & second_head.isNotNull()
    answers = F.struct(
        F.when(retried, second_head).otherwise(head_status).alias("head"),
        F.when(retried, second_get).otherwise(get_status).alias("get"),
        F.when(retried, second_final).otherwise(head_final).alias("final"),
        retried.alias("retried"))

    def bare(address):
        return F.regexp_replace(address, "/+$", "")

    def told(a):
        """One status, and whether the redirect landed where the site sends what is missing.
        A GET that stood in for a refused HEAD has no final address."""
        again = (a["head"] >= 400) & (a["head"] != 429)
        soft = ~again & (bare(a["final"]) != bare(url)) & (bare(a["final"]) == bare(baseline_final))
        return F.struct(
            F.when(again, F.coalesce(a["get"], a["head"])).otherwise(a["head"]).alias("status"),
            F.coalesce(soft, F.lit(False)).alias("soft"), a["retried"].alias("retried"))

    def verdict(state, reason, cert, answered):
        return F.struct(F.lit(state).alias("status"), reason.cast("string").alias("reason"),
                        cert.alias("invalid_cert"),
                        F.lit(answered).cast("boolean").alias("answered"))

    def judged(p):
        no, status, cert = F.lit(False), p["status"], p["retried"]
        http = scheme_of(url).isin("http", "https") & (host_of(url) != "")
        failed = error.isNotNull() & ~cert
        return (F.when(~http, verdict("unverified", F.lit("not an http address"), no, None))
                .when(failed & (error == "timeout"),
                      verdict("unverified", F.lit("timeout"), no, False))
                .when(failed & ~F.coalesce(host_known, F.lit(True)),
                      verdict("dead", F.lit("host not found"), no, None))
                .when(failed, verdict("unverified", error, no, False))
                .when(status == 429, verdict("unverified", F.lit(TOO_MANY_REQUESTS), no, True))
                .when(status.isin(GONE), verdict("dead", status_phrase(status), cert, True))
                .when(status >= 400, verdict("unverified", status_phrase(status), cert, True))
                .when(p["soft"], verdict("dead", F.lit("soft 404"), cert, True))
                .otherwise(verdict("alive", null_text, cert, True)))

    return let(answers, lambda a: let(told(a), judged))
