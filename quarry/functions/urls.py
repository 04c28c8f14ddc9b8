"""C30 URL resolution: an href against a base, in Python (inside the Arrow page-parsing tasks) and as a Column.

Both follow the WHATWG rules for the web's schemes: tabs and newlines go, surrounding spaces are trimmed,
backslashes are slashes, dot segments are resolved (an encoded dot is a dot), scheme and host are
lower-cased, default ports dropped, and path, query and fragment percent-encoded with the standard's sets
(non-ASCII as UTF-8). URLs of other schemes stay as written. None (null) where nothing can be resolved: no
scheme on either side, no host, a host with forbidden characters, a port that isn't one.

A host beyond ASCII has a name in IDNA, which SQL functions can't compute: ``resolve_href`` gives null for it
and ``beyond_ascii_host`` tells such rows, which ``operators.pages.absolute_links`` hands to the Python form.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

_PATH_SAFE = "!$%&'()*+,-./:;=@[\\]^_|~"
_QUERY_SAFE = "!$%&()*+,-./:;=?@[\\]^_`{|}~"
_FRAG_SAFE = "!#$%&'()*+,-./:;=?@[\\]^_{|}~"
_DEFAULT_PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?([^?#]*)(\?[^#]*)?(#.*)?$"
_AUTHORITY = r"(?s)^(?:(.*)@)?(\[[0-9A-Fa-f:.]+\]|[^:@\[\]]*)(?::([0-9]*))?$"
_FORBIDDEN = r"[\x00-\x20#%/<>?@\\^|\x7F]"
_DOT = r"(?i)^(?:\.|%2e)$"
_TWO_DOTS = r"(?i)^(?:\.|%2e){2}$"
_ANY_DOTS = r"(?i)/(?:\.|%2e){1,2}(?:/|$)"
# Most hrefs are in their final form: nothing to encode, no dot segments, no port; or such a path on such a host.
_PLAIN_PATH = re.compile(r"(?:/[A-Za-z0-9_~-][A-Za-z0-9_~.-]*)+/?")
_PLAIN_URL = re.compile(r"(https?://[a-z0-9-]+(?:\.[a-z0-9-]+)+)" + _PLAIN_PATH.pattern)


def _without_dots(path: str) -> str:
    """Dot segments of an absolute path resolved; an encoded dot is one too."""
    out: list[str] = []
    segments = path.split("/")[1:]
    for i, s in enumerate(segments):
        plain = s.lower().replace("%2e", ".")
        if plain in (".", ".."):
            if plain == ".." and out:
                out.pop()
            if i == len(segments) - 1:
                out.append("")
        else:
            out.append(s)
    return "/" + "/".join(out)


def _ascii_host(host: str) -> str:
    """Lower-cased; a name beyond ASCII in its IDNA form (raises ValueError if it has none)."""
    return host.lower() if host.isascii() else host.lower().encode("idna").decode("ascii")


def _clean(url: str) -> str:
    return re.sub(r"[\t\n\r]", "", url).strip(" \f\x00")


def _split(url: str) -> tuple[str, str, str | None, str | None]:
    """Scheme in lower case ('' if none), what stands before query and fragment, and these with their marks."""
    scheme, head, query, fragment = re.match(_PARTS, url).groups()
    return (scheme or "").lower(), head, query, fragment


def resolve_url(href: str | None, base: str | None) -> str | None:
    if href is None:
        return None
    if _PLAIN_URL.fullmatch(href):
        return href
    if _PLAIN_PATH.fullmatch(href) and (on := _PLAIN_URL.fullmatch(base or "")):
        return on.group(1) + href
    h = _clean(href)
    scheme, head, query, fragment = _split(h)
    if scheme and scheme not in _DEFAULT_PORTS:
        return h
    head = head.replace("\\", "/")
    b_scheme, b_head, b_query, _ = _split(_clean(base or ""))
    if not scheme or (scheme == b_scheme and not head.startswith("//")):
        if b_scheme not in _DEFAULT_PORTS:
            return None
        scheme = b_scheme
        authority, _, b_path = b_head.replace("\\", "/").lstrip("/").partition("/")
        if head.startswith("//"):
            authority, _, path = head.lstrip("/").partition("/")
            path = "/" + path
        elif head.startswith("/"):
            path = head
        elif head:
            path = ("/" + b_path).rpartition("/")[0] + "/" + head
        else:
            path, query = "/" + b_path, query if query is not None else b_query
    else:
        authority, _, path = head.lstrip("/").partition("/")
        path = "/" + path
    found = re.match(_AUTHORITY, authority)
    if not found:
        return None
    user, host, port = found.groups()
    try:
        host = _ascii_host(host)
    except ValueError:
        return None
    if not host or re.search(_FORBIDDEN, host) or (port and int(port) > 65535):
        return None
    name, _, password = (user or "").partition(":")
    auth = name + (f":{password}" if password else "") + "@" if name or password else ""
    out = f"{scheme}://{auth}{host}" + (f":{int(port)}" if port and int(port) != _DEFAULT_PORTS[scheme] else "")
    out += quote(_without_dots(path), safe=_PATH_SAFE)
    if query is not None:
        out += "?" + quote(query[1:], safe=_QUERY_SAFE)
    if fragment is not None:
        out += "#" + quote(fragment[1:], safe=_FRAG_SAFE)
    return out


def _bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def _clean_column(url: Column) -> Column:
    return F.btrim(F.regexp_replace(url, r"[\t\n\r]", ""), F.lit(" \f\x00"))


def _split_column(url: Column) -> Column:
    """scheme, head, query, fragment as ``_split``; a part that isn't there is null."""
    part = lambda k: F.nullif(F.regexp_extract(url, _PARTS, k), F.lit(""))
    return F.struct(F.lower(F.regexp_extract(url, _PARTS, 1)).alias("scheme"), F.regexp_extract(url, _PARTS, 2).alias("head"),
                    part(3).alias("query"), part(4).alias("fragment"))


def _place(rest: Column) -> tuple[Column, Column]:
    """Authority and path of what follows the scheme; any number of slashes may come first."""
    rest = F.regexp_replace(rest, "^/+", "")
    return F.regexp_extract(rest, "(?s)^([^/]*)", 1), F.concat(F.lit("/"), F.regexp_extract(rest, "(?s)^[^/]*/(.*)$", 1))


def _quoted(text: Column, safe: str) -> Column:
    """Percent-encoded but for letters, digits, '_' and ``safe``."""
    kept = "[A-Za-z0-9_" + "".join("\\" + c for c in safe if not c.isalnum() and c != "_") + "]"
    sign = lambda c: F.when(c.rlike(f"^{kept}$"), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1"))
    return F.when(text.rlike(f"^{kept}*\\z"), text).otherwise(F.array_join(F.transform(F.split(text, ""), sign), ""))


def _without_dots_column(path: Column) -> Column:
    def fold(segments: Column) -> Column:
        kept = F.aggregate(
            segments, F.array().cast("array<string>"),
            lambda out, s: F.when(s.rlike(_TWO_DOTS), F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))))
            .when(s.rlike(_DOT), out).otherwise(F.concat(out, F.array(s))))
        last = F.element_at(segments, -1)
        open_end = F.when(last.rlike(_DOT) | last.rlike(_TWO_DOTS), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, open_end), "/"))

    return F.when(path.rlike(_ANY_DOTS), _bound(F.split(F.substr(path, F.lit(2)), "/", -1), fold)).otherwise(path)


def _joined(href: Column, base: Column, finish) -> Column:
    """``finish`` of struct(scheme, authority, path, query, fragment), whose scheme is null where nothing can be resolved."""
    known = list(_DEFAULT_PORTS)

    def join(p: Column) -> Column:
        h, b = p["h"], p["b"]
        head = F.translate(h["head"], "\\", "/")
        relative = (h["scheme"] == "") | ((h["scheme"] == b["scheme"]) & ~head.startswith("//"))
        b_at, b_path = _place(F.translate(b["head"], "\\", "/"))
        at, path = _place(head)
        own = ~relative | head.startswith("//")
        scheme = F.when(~relative, h["scheme"]).when(b["scheme"].isin(known), b["scheme"])
        own_path = (F.when(own, path).when(head.startswith("/"), head)
                    .when(head != "", F.concat(F.regexp_extract(b_path, "(?s)^(.*/)", 1), head)).otherwise(b_path))
        query = F.when((head == "") & ~own, F.coalesce(h["query"], b["query"])).otherwise(h["query"])
        return F.struct(scheme.alias("scheme"), F.when(own, at).otherwise(b_at).alias("authority"), own_path.alias("path"),
                        query.alias("query"), h["fragment"].alias("fragment"))

    parts = F.struct(_bound(_clean_column(href), _split_column).alias("h"),
                     _bound(_clean_column(F.coalesce(base, F.lit(""))), _split_column).alias("b"))
    return _bound(parts, lambda p: F.when(p["h"]["scheme"].isin("", *known), _bound(join(p), finish)))


def resolve_href(href: Column, base: Column) -> Column:
    """C30 as a Column: ``href`` against ``base``, as ``resolve_url`` but for hosts beyond ASCII, which give null."""

    def finish(u: Column) -> Column:
        def written(a: Column) -> Column:
            host, port = F.lower(a["host"]), F.try_to_number(F.nullif(a["port"], F.lit("")), F.lit("9" * 18)).cast("long")
            default = F.element_at(F.create_map(*[F.lit(x) for kv in _DEFAULT_PORTS.items() for x in kv]), u["scheme"])
            name, password = F.regexp_extract(a["user"], "(?s)^([^:]*)", 1), F.regexp_extract(a["user"], "(?s)^[^:]*:(.*)$", 1)
            auth = F.when((name != "") | (password != ""),
                          F.concat(name, F.when(password != "", F.concat(F.lit(":"), password)).otherwise(""), F.lit("@"))).otherwise("")
            ok = (u["scheme"].isNotNull() & u["authority"].rlike(_AUTHORITY) & (host != "") & host.rlike(r"^[\x00-\x7F]*\z")
                  & ~host.rlike(_FORBIDDEN) & ((a["port"] == "") | (port <= 65535)))
            shown = F.when((a["port"] != "") & (port != default), F.concat(F.lit(":"), port.cast("string"))).otherwise("")
            after = lambda c, mark, safe: F.coalesce(F.concat(F.lit(mark), _quoted(F.substr(c, F.lit(2)), safe)), F.lit(""))
            return F.when(ok, F.concat(u["scheme"], F.lit("://"), auth, host, shown,
                                       _bound(_without_dots_column(u["path"]), lambda p: _quoted(p, _PATH_SAFE)),
                                       after(u["query"], "?", _QUERY_SAFE), after(u["fragment"], "#", _FRAG_SAFE)))

        part = lambda k: F.regexp_extract(u["authority"], _AUTHORITY, k)
        return _bound(F.struct(part(1).alias("user"), part(2).alias("host"), part(3).alias("port")), written)

    cleaned = _clean_column(href)
    other = F.regexp_extract(cleaned, _PARTS, 1)
    return F.when((other != "") & ~F.lower(other).isin(*_DEFAULT_PORTS), cleaned).otherwise(_joined(href, base, finish))


def beyond_ascii_host(href: Column, base: Column) -> Column:
    """Whether the resolved URL's host holds characters beyond ASCII (false where nothing is resolved)."""
    found = _joined(href, base, lambda u: u["scheme"].isNotNull() & F.regexp_extract(u["authority"], _AUTHORITY, 2).rlike(r"[^\x00-\x7F]"))
    return F.coalesce(found, F.lit(False))
