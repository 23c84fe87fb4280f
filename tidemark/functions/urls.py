"""URL columns with the parsing rules of ``java.net.URL``.

Only characters and structure are looked at, so spaces inside a path are fine,
while an unknown protocol or a bad port makes the URL malformed. All work is
done by built-in expressions. A single pattern recognises plain web addresses,
which then need only substring work; everything else takes the full rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Protocols the platform knows.
SERVER_PROTOCOLS = ("http", "https", "ftp", "file")
OPAQUE_PROTOCOLS = ("jar", "mailto")

# A plain address: lower-case protocol, bare host, a path without dot segments
# and without blanks. Only single-character loops, so long paths cannot exhaust
# the matcher's stack.
_PLAIN = (
    r"^(?:https?|ftp)://[^/?#@:\[\x00-\x20]++"
    r"(?![^?#]*/\.)(?![^?#]*[\x00-\x20])(?:/[^?#]*+)?(?:[?#]|\z)"
)
# The host of an address whose authority is plain, whatever follows it.
_PLAIN_HOST = r"^(?:https?|ftp)://[^/?#@:\[\x00-\x20]++(?:[/?#]|\z)"
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+\z"
_HAS_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|\z)"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _is_plain(url: Column) -> Column:
    return url.rlike(_PLAIN)


def _plain_base(url: Column) -> Column:
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a plain column would be copied
    into the plan at every place that uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _clean_path(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; a ``..`` with nothing above it stays."""
    resolved = _let(F.split(path, "/", -1), _resolve_segments)
    # A relative path is kept as it is but for a leading "./".
    return (
        F.when(~path.rlike(_HAS_DOT_SEGMENT), path)
        .when(path.startswith("/"), resolved)
        .otherwise(F.regexp_replace(path, r"^\./(?=.)", ""))
    )


def _resolve_segments(segments: Column) -> Column:
    def step(done: Column, segment: Column) -> Column:
        can_pop = (F.size(done) > 1) & (F.element_at(done, -1) != "..")
        return (
            F.when(segment == ".", done)
            .when((segment == "..") & can_pop, F.slice(done, F.lit(1), F.size(done) - 1))
            .otherwise(F.array_append(done, segment))
        )

    def join(folded: Column) -> Column:
        last = F.element_at(segments, -1)
        dangling = (last == ".") | ((last == "..") & (F.element_at(folded, -1) != ".."))
        return F.concat(F.array_join(folded, "/"), F.when(dangling, F.lit("/")).otherwise(F.lit("")))

    rest = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    return _let(F.aggregate(rest, F.slice(segments, 1, 1), step), join)


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _parts(protocol: Column, authority: Column, host: Column, path: Column) -> Column:
    return F.struct(
        protocol.alias("protocol"), authority.alias("authority"), host.alias("host"), path.alias("path")
    )


def _opaque_parts(protocol: Column, body: Column) -> Column:
    fine = F.when(
        protocol == "jar", body.contains("!/") & body.rlike(r"^(?i:https?|ftp|file|jar):")
    ).otherwise(F.length(F.trim(body)) > 0)
    path = F.substring_index(body, "?", 1)
    return F.when(fine, _parts(protocol, _null_text(), F.lit(""), path))


def _host(authority: Column) -> Column:
    """The host of an authority, null when host or port are malformed."""

    def with_server(server: Column) -> Column:
        bracketed = server.startswith("[")
        port = F.when(bracketed, F.regexp_extract(server, r"^\[[^\]]*\]:?(.*)$", 1)).otherwise(
            F.regexp_extract(server, r"^[^:]*:(.*)$", 1)
        )
        port_ok = _let(
            port,
            lambda text: (text == "")
            | (text.rlike(r"^[+-]?[0-9]+\z") & (F.coalesce(text.try_cast("int"), F.lit(-2)) >= -1)),
        )
        literal = r"^(\[[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%[^\]]+)?\])(?::.*)?\z"
        host = F.when(
            bracketed, F.when(server.rlike(literal), F.regexp_extract(server, literal, 1))
        ).otherwise(F.substring_index(server, ":", 1))
        return F.when(port_ok, host)

    # Without an authority, or with two or more @ in it, the host is empty.
    plain = F.size(F.split(authority, "@", -1)) <= 2
    return F.when(
        authority.isNotNull() & plain, _let(F.substring_index(authority, "@", -1), with_server)
    ).otherwise(F.lit(""))


def _server_parts(protocol: Column, located: Column) -> Column:
    has_authority = located.startswith("//") & ~located.startswith("////")
    authority = F.when(has_authority, F.regexp_extract(located, r"^//([^/]*)", 1))
    path = F.when(has_authority, F.regexp_replace(located, r"^//[^/]*", "")).otherwise(located)

    def with_host(found: Column) -> Column:
        parts = _parts(protocol, found["authority"], found["host"], _clean_path(found["path"]))
        return F.when(found["host"].isNotNull(), parts)

    def with_pieces(pieces: Column) -> Column:
        host = _host(pieces["authority"]).alias("host")
        return _let(
            F.struct(pieces["authority"].alias("authority"), pieces["path"].alias("path"), host),
            with_host,
        )

    return _let(F.struct(authority.alias("authority"), path.alias("path")), with_pieces)


def url_parts(url) -> Column:
    """Struct ``(protocol, authority, host, path)``, null when malformed."""

    def with_text(text: Column) -> Column:
        def with_scheme(scheme: Column) -> Column:
            body = F.substring_index(F.substr(text, F.length(scheme) + 2), "#", 1)
            protocol = F.lower(scheme)
            return (
                F.when(
                    protocol.isin(*SERVER_PROTOCOLS),
                    _let(F.substring_index(body, "?", 1), lambda rest: _server_parts(protocol, rest)),
                )
                .when(
                    protocol.isin(*OPAQUE_PROTOCOLS),
                    _let(body, lambda rest: _opaque_parts(protocol, rest)),
                )
            )

        return _let(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9.+\-]*):", 1), with_scheme)

    trimmed = F.regexp_replace(_col(url), _EDGE_BLANKS, "")
    return _let(F.regexp_replace(trimmed, r"^(?i:url:)", ""), with_text)


def normalize_url(url) -> Column:
    """Protocol, host and path only; a malformed URL stays as it is."""
    url = _col(url)
    full = _let(
        url_parts(url),
        lambda parts: F.concat(parts["protocol"], F.lit("://"), parts["host"], parts["path"]),
    )
    return F.when(_is_plain(url), _plain_base(url)).otherwise(F.coalesce(full, url))


def extract_domain(url) -> Column:
    """The authority (host, port and user info); null when malformed."""
    url = _col(url)
    plain = F.split_part(_plain_base(url), F.lit("/"), F.lit(3))
    return F.when(url.rlike(_PLAIN_HOST), plain).otherwise(url_parts(url)["authority"])


def has_domain(url) -> Column:
    """Whether ``extract_domain`` gives a value, at the cost of one match for a
    plain address."""
    url = _col(url)
    return url.rlike(_PLAIN_HOST) | url_parts(url)["authority"].isNotNull()


def strict_normalize_url(url) -> Column:
    """Like ``normalize_url`` under strict URI rules, by Spark's own parser."""
    url = _col(url)
    scheme = F.try_parse_url(url, F.lit("PROTOCOL"))
    host = F.try_parse_url(url, F.lit("HOST"))
    path = F.try_parse_url(url, F.lit("PATH"))
    return F.coalesce(F.concat(scheme, F.lit("://"), host, path), url)
