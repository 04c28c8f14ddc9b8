"""Scalar Column expressions (C01-C26, C30 for the /path form, F05-F14).

Every function takes and returns ``pyspark.sql.Column`` and compiles to
JVM built-ins only, so it runs inside whole-stage codegen on any row count
and also works on a streaming DataFrame.

Regex dialect notes (the behaviour being matched is ECMAScript's):
* ECMAScript ``\\s`` is Unicode whitespace; Java's is ASCII, so ``JSWS``
  spells the ECMAScript class out.
* ECMAScript ``\\b`` is ASCII-only; Java treats accented letters as word
  characters, so boundaries are written as ASCII look-arounds.
* Case-insensitive matching is ASCII-only ``(?i)`` (no UNICODE_CASE).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# ECMAScript whitespace as a Java character class.
JSWS = r"[\s\x{0B}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# ASCII word boundaries (ECMAScript \b without the u flag).
WB_BEFORE = r"(?<![A-Za-z0-9_])"
WB_AFTER = r"(?![A-Za-z0-9_])"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _s(x) -> Column:
    """Null-safe string: null -> ''."""
    return F.coalesce(_c(x).cast("string"), F.lit(""))


def ascii_lower(c) -> Column:
    """Lower-case A-Z only (ECMAScript /i without the u flag folds ASCII only)."""
    return F.translate(_c(c), _UPPER, _LOWER)


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


# -- C01 ---------------------------------------------------------------------

def norm_ws(c) -> Column:
    """Null -> ''; runs of (ECMAScript) whitespace -> one space; trim."""
    return F.trim(F.regexp_replace(_s(c), JSWS + "+", " "))


# -- C05 ---------------------------------------------------------------------

_ENTITY_RE = r"(?i)&(#x?[0-9a-f]+|[a-z]+);"
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}


def _code_point(n: Column) -> Column:
    """int code point -> one-character string (UTF-32 decode, not chr())."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _decode_one_entity(m: Column) -> Column:
    """Decode one matched entity; unknown names and invalid code points stay literal."""
    code = F.regexp_replace(m, "^&|;$", "")
    lcode = F.lower(code)
    hexd = F.regexp_extract(lcode, r"^#x0*([0-9a-f]*)$", 1)
    is_hex = lcode.startswith("#x")
    dec_zero = F.regexp_extract(code, r"^#(0*)", 1)
    dec = F.regexp_extract(code, r"^#0*([0-9]*)", 1)
    is_dec = code.startswith("#") & ~is_hex
    hex_val = F.when(F.length(hexd) == 0, F.lit(0)).otherwise(
        F.conv(hexd, 16, 10).cast("int"))
    dec_ok = (F.length(dec) > 0) | (F.length(dec_zero) > 0)
    dec_val = F.when(F.length(dec) == 0, F.lit(0)).otherwise(F.substring(dec, 1, 8).cast("int"))
    valid_cp = lambda v: (v <= 0x10FFFF) & ~((v >= 0xD800) & (v <= 0xDFFF))
    named = reduce(lambda acc, kv: acc.when(lcode == kv[0], F.lit(kv[1])),
                   list(_NAMED.items())[1:],
                   F.when(lcode == "amp", F.lit("&")))
    return (
        F.when(is_hex & (F.length(hexd) <= 6) & valid_cp(hex_val), _code_point(hex_val))
        .when(is_dec & dec_ok & (F.length(dec) <= 7) & valid_cp(dec_val), _code_point(dec_val))
        .when(~code.startswith("#"), F.coalesce(named, m))
        .otherwise(m)
    )


def decode_entities(c) -> Column:
    """One left-to-right pass of entity decoding (numeric, hex, 6 named).

    Implemented as split-by-regex zipped with the matches, so every match is
    decoded exactly once in a single pass (a chain of regexp_replace calls
    would decode '&amp;lt;' twice).
    """
    def one_pass(s: Column) -> Column:
        parts = F.split(s, _ENTITY_RE, -1)
        matches = F.regexp_extract_all(s, F.lit(_ENTITY_RE), 0)
        joined = F.array_join(
            F.zip_with(parts, matches,
                       lambda a, b: F.concat(F.coalesce(a, F.lit("")),
                                             F.coalesce(_decode_one_entity(b), F.lit("")))),
            "")
        return F.when(s.contains("&"), joined).otherwise(s)
    # bind the input once (lambda variable) instead of re-evaluating it three times
    return F.transform(F.array(_s(c)), one_pass)[0]


def strip_html(c) -> Column:
    """Decode entities twice, tags -> space, then C01."""
    return norm_ws(F.regexp_replace(decode_entities(decode_entities(c)), "<[^>]*>", " "))


# -- C06 ---------------------------------------------------------------------

def _is_index(key: Column) -> Column:
    """An integer-like key (ECMAScript array index, up to 2^32 - 2) iterates before the others."""
    return key.rlike("^(0|[1-9][0-9]{0,9})$") & (key.try_cast("long") <= 4294967294)


def reconstruct_abstract(inverted_index) -> Column:
    """MAP<STRING, ARRAY<INT>> token->positions -> text, no shuffle.

    Tokens are placed at their positions and joined by single spaces; gaps
    collapse via C01.  On a position collision the key that iterates later
    wins, with integer-like keys iterating first (ascending).
    """
    m = _c(inverted_index)
    entries = F.map_entries(m)

    def ranked(e, i):
        # integer-like keys iterate first, ascending; the rest in map order.  Once a key, not once a position
        at = F.when(_is_index(e["key"]), F.struct(F.lit(0).alias("g"), e["key"].cast("long").alias("r"))) \
            .otherwise(F.struct(F.lit(1).alias("g"), i.cast("long").alias("r")))
        return F.struct(e["key"].alias("key"), e["value"].alias("value"), at.alias("at"))

    placed = F.flatten(F.transform(F.transform(entries, ranked), lambda e: F.transform(
        e["value"], lambda p: F.struct(p.alias("p"), e["at"].alias("at"), e["key"].alias("key")))))
    ordered = F.sort_array(placed)
    last_per_pos = F.transform(F.array(ordered), lambda s: F.filter(
        s, lambda x, i: (i + 1 == F.size(s)) | (F.get(s, i + 1)["p"] != x["p"])))
    tokens = F.transform(F.get(last_per_pos, 0), lambda x: x["key"])
    return F.when(m.isNull(), F.lit("")).otherwise(norm_ws(F.array_join(tokens, " ")))


# -- C07 / C08 / C09 / C10 -------------------------------------------------------

def crossref_date(date_parts) -> Column:
    """ARRAY<INT> date-parts[0] -> 'y-m-d' without zero padding; null/0 parts dropped."""
    p = _c(date_parts)
    return F.coalesce(
        F.array_join(F.transform(F.filter(p, lambda x: x.isNotNull() & (x != 0)),
                                 lambda x: x.cast("string")), "-"),
        F.lit(""))


_DOI_PREFIX = r"^https?://doi\.org/"


def doi_url(doi) -> Column:
    """C08: '' if empty, else https://doi.org/ + doi without a URL prefix."""
    d = _s(doi)
    return F.when(d == "", F.lit("")).otherwise(
        F.concat(F.lit(K.DOI_BASE), F.regexp_replace(d, _DOI_PREFIX, "")))


def normalize_doi(doi) -> Column:
    """Lower, strip the doi.org prefix, strip one trailing .digits / .vdigits."""
    return F.regexp_replace(F.regexp_replace(F.lower(_s(doi)), _DOI_PREFIX, ""), r"\.v?[0-9]+$", "")


def normalized_title(title) -> Column:
    return F.trim(F.regexp_replace(F.lower(_s(title)), "[^a-z0-9]+", " "))


def dedupe_key(title, doi) -> Column:
    """C10: 'title:' + normalised title if >= 15 chars, else 'doi:' + C09, else 'title:' + t."""
    t = normalized_title(title)
    d = _s(doi)
    return (F.when(F.length(t) >= 15, F.concat(F.lit("title:"), t))
            .when(d != "", F.concat(F.lit("doi:"), normalize_doi(d)))
            .otherwise(F.concat(F.lit("title:"), t)))


# -- C12 / C13 ---------------------------------------------------------------

def slugify(doi, title, index) -> Column:
    """(doi || title || row-i) lower-cased, non [a-z0-9] runs -> '-', trimmed, 80 chars (the ids' fixed format).

    Different articles may share a slug: it is a label, never a join key.
    """
    fallback = F.concat(F.lit("row-"), _c(index).cast("string"))
    base = F.coalesce(F.nullif(_s(doi), F.lit("")), F.nullif(_s(title), F.lit("")), fallback)
    slug = F.substring(
        F.regexp_replace(F.regexp_replace(F.lower(base), "[^a-z0-9]+", "-"), "^-+|-+$", ""),
        1, K.SLUG_MAX_CHARS)
    return F.coalesce(F.nullif(slug, F.lit("")), fallback)


def evidence_id(article_id, kind: str, n) -> Column:
    """{article}-{table|figure|dataset}-{n}."""
    return F.concat_ws("-", _c(article_id), F.lit(kind), _c(n).cast("string"))


# -- C14 / C15 / C16 / C17 / C18 -----------------------------------------------

def _extname(p: Column) -> Column:
    """Extension of the last path segment; dot-files have none."""
    base = F.regexp_extract(p, r"([^/]*)/*$", 1)
    return F.regexp_extract(base, r"^.+(\.[^.]*)$", 1)


def _basename(p: Column) -> Column:
    return F.regexp_extract(p, r"([^/]*)/*$", 1)


# URLs of the web with a path as most have it: it stands as it is in the decoded form.
_PLAIN_PATH = r"^https?://[A-Za-z0-9][A-Za-z0-9.\-]*(/[A-Za-z0-9._~/\-]*)\z"
# Names that no rule of ``safe_file_name`` changes.
_SAFE_NAME = r"^[a-zA-Z0-9._]++(?:-[a-zA-Z0-9._]++)*+\z"


def _url_path_decoded(u: Column) -> Column:
    """Percent-decoded path of an absolute URL, NULL if not a URL or undecodable."""
    return F.when(u.rlike(_PLAIN_PATH), F.regexp_extract(u, _PLAIN_PATH, 1)).otherwise(_odd_path_decoded(u))


def _odd_path_decoded(u: Column) -> Column:
    # a URL parser encodes what a URI parser rejects: white space, quotes, braces, bars and the like
    legal = reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit(f"%{ord(ch):02X}")), ' "<>`{}|^\\', F.trim(u))
    path = F.call_function("try_parse_url", legal, F.lit("PATH"))
    has_scheme = u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    decoded = F.call_function("try_url_decode", F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(has_scheme, decoded)


def path_extension(url) -> Column:
    """C14: lower-cased extension of the decoded URL path; else of the text before ?/#."""
    u = _s(url)
    text_branch = _extname(F.regexp_extract(u, r"^([^?#]*)", 1))
    return F.lower(F.coalesce(_extname(_url_path_decoded(u)), text_branch))


def file_name_from_url(url) -> Column:
    """Decoded basename of the URL path, '' when not a URL."""
    return F.coalesce(_basename(_url_path_decoded(_s(url))), F.lit(""))


def safe_file_name(value, fallback="dataset-file") -> Column:
    """File-system-safe name, 120 chars, with fallback."""
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    s = _s(value)
    v = norm_ws(s)
    v = F.regexp_replace(v, r'[/\\?%*:|"<>]', "-")
    v = F.regexp_replace(v, r"[^a-zA-Z0-9._ -]+", "-")
    v = F.regexp_replace(v, r"\s+", "-")
    v = F.regexp_replace(v, r"-+", "-")
    v = F.substring(F.regexp_replace(v, r"^-+|-+$", ""), 1, K.SAFE_NAME_MAX_CHARS)
    safe = (F.length(s) <= K.SAFE_NAME_MAX_CHARS) & s.rlike(_SAFE_NAME)
    return F.when(safe, s).otherwise(F.coalesce(F.nullif(v, F.lit("")), fb))


def file_name_from_disposition(disposition) -> Column:
    """C17: RFC 5987 filename*=UTF-8''... (decoded) before filename=... ."""
    d = _s(disposition)
    enc = F.regexp_extract(d, r"(?i)filename\*=UTF-8''([^;]+)", 1)
    enc_dec = F.call_function("try_url_decode", F.replace(enc, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_extract(d, r'(?i)filename="?([^";]+)"?', 1)
    return F.when(enc != "", F.coalesce(enc_dec, plain)).otherwise(plain)


def extension_from_content_type(content_type) -> Column:
    """First matching content-type rule -> extension, else ''."""
    ct = F.lower(_s(content_type))
    expr = None
    for frag, ext in K.CONTENT_TYPE_EXTENSIONS:
        expr = (F.when(ct.contains(frag), F.lit(ext)) if expr is None
                else expr.when(ct.contains(frag), F.lit(ext)))
    return expr.otherwise(F.lit(""))


def with_extension(name, content_type) -> Column:
    """Keep a name that has an extension, else append C18a or '.dat'."""
    n = _s(name)
    ext = F.coalesce(F.nullif(extension_from_content_type(content_type), F.lit("")), F.lit(".dat"))
    return F.when(_extname(n) != "", n).otherwise(F.concat(n, ext))


# -- C19 / C21 / C22 -----------------------------------------------------------

# The patterns of deposits are tried on URLs that have their host's or repository's name at all.

def _names(u: Column, name: str) -> Column:
    return F.lower(u).contains(name)


def zenodo_record_id(url) -> Column:
    u = _s(url)
    return F.when(_names(u, "zenodo"), F.coalesce(
        F.nullif(F.regexp_extract(u, r"(?i)zenodo\.org/(?:record|records)/([0-9]+)", 1), F.lit("")),
        F.regexp_extract(u, r"(?i)10\.5281/zenodo\.([0-9]+)", 1))).otherwise(F.lit(""))


def figshare_article_id(url) -> Column:
    u = _s(url)
    return F.when(_names(u, "figshare"), F.coalesce(
        F.nullif(F.regexp_extract(u, r"(?i)figshare\.com/articles/(?:[^/]+/)?[^/?#]+/([0-9]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(u, r"(?i)figshare\.com/ndownloader/articles/([0-9]+)", 1), F.lit("")),
        F.regexp_extract(u, r"(?i)10\.6084/m9\.figshare\.([0-9]+)", 1))).otherwise(F.lit(""))


_MENDELEY_PAGE = r"(?i)data\.mendeley\.com/datasets/([a-z0-9]+)(?:/([0-9]+))?"
_MENDELEY_DOI = r"(?i)10\.17632/([a-z0-9]+)(?:\.([0-9]+))?"


def mendeley_ref(url) -> Column:
    """STRUCT<id, version> or NULL; id keeps its case, version may be ''."""
    u = _s(url)
    page = _names(u, "data.mendeley.com/datasets/") & u.rlike(_MENDELEY_PAGE)
    doi = u.contains("10.17632/") & u.rlike(_MENDELEY_DOI)
    return (F.when(page, F.struct(F.regexp_extract(u, _MENDELEY_PAGE, 1).alias("id"),
                                  F.regexp_extract(u, _MENDELEY_PAGE, 2).alias("version")))
            .when(doi, F.struct(F.regexp_extract(u, _MENDELEY_DOI, 1).alias("id"),
                                F.regexp_extract(u, _MENDELEY_DOI, 2).alias("version"))))


def dataset_identity(url) -> Column:
    """Mendeley:ID | zenodo:N | figshare:N | lower-cased URL without trailing '/'."""
    u = _s(url)
    return F.coalesce(
        F.concat(F.lit("mendeley:"), mendeley_ref(u)["id"]),
        F.concat(F.lit("zenodo:"), F.nullif(zenodo_record_id(u), F.lit(""))),
        F.concat(F.lit("figshare:"), F.nullif(figshare_article_id(u), F.lit(""))),
        F.lower(F.regexp_replace(u, "/+$", "")))


def data_yield_rank(source, kind, title) -> Column:
    """+2 data source, +2 kind = dataset, +1 whole word data/dataset in title."""
    return (F.when(_s(source).isin(K.DATA_SOURCE_NAMES), 2).otherwise(0)
            + F.when(F.lower(_s(kind)) == "dataset", 2).otherwise(0)
            + F.when(_s(title).rlike(WB_BEFORE + "(?i:data(set)?)" + WB_AFTER), 1).otherwise(0))


# A tag's attributes, quoted values included.  Possessive throughout, and a tag that never ends takes the rest of
# the page with it, so that a page is read once.
_ATTRIBUTES = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+'|)[^>=]*+)*+"""
_RAW_TEXT = "s(?:cript|tyle)|t(?:extarea|itle)|xmp|iframe|no(?:embed|frames)"
# Everything up to a table's tag is one match: other tags, comments and raw text, and what stands between.
_TABLE_TAGS = (r"(?is)(?=<)(?:<(?:/[a-z]" + _ATTRIBUTES + r"(?:>|\z)|!--.*?(?:-->|\z)|(" + _RAW_TEXT + r")(?=[\s/>])" + _ATTRIBUTES
               + r">.*?(?:</\1(?=[\s/>])|\z)|(?!table(?=[\s/>])" + _ATTRIBUTES + r">)[a-z]" + _ATTRIBUTES + r"(?:>|\z))[^<]*+)*+"
               + r"(?:<(table)(?=[\s/>])" + _ATTRIBUTES + r">)?")


def table_count(body) -> Column:
    """How many table elements an HTML body opens, without building its tree.

    Comments, raw-text elements and attribute values don't count.  JVM-side, so that a choice between
    copies needs no parser and moves no body.  Bodies without such a tag anywhere aren't taken apart.
    """
    b = _s(body)
    tags = F.size(F.array_remove(F.regexp_extract_all(b, F.lit(_TABLE_TAGS), F.lit(2)), ""))
    return F.when(b.rlike(r"(?i)<table[\s/>]"), tags).otherwise(F.lit(0))


# -- C23 / C24 / C25 / C26 --------------------------------------------------------

def extraction_status(attempted, loaded) -> Column:
    """C23."""
    return (F.when(_c(loaded), F.lit("loaded")).when(_c(attempted), F.lit("failed"))
            .otherwise(F.lit("not_attempted")))


def download_status(status, n_files, n_errors) -> Column:
    """Explicit status, else downloaded / failed / linked."""
    return F.coalesce(F.nullif(_s(status), F.lit("")),
                      F.when(_c(n_files) > 0, F.lit("downloaded"))
                      .when(_c(n_errors) > 0, F.lit("failed"))
                      .otherwise(F.lit("linked")))


def csv_escape(c) -> Column:
    """Quote iff the text holds '"', ',', CR or LF; double inner quotes; null -> ''."""
    s = _s(c)
    return F.when(s.rlike('["\\n\\r,]'),
                  F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def pmc_article_url(pmcid) -> Column:
    """C26a."""
    p = _s(pmcid)
    return F.when(p == "", F.lit("")).otherwise(F.concat(F.lit(K.PMC_ARTICLE_BASE), p, F.lit("/")))


def jats_image_url(pmcid, href) -> Column:
    """.../articles/{pmcid}/bin/{href, or href.jpg when it has no extension}."""
    h = _s(href)
    name = F.when((h != "") & ~h.rlike(r"(?i)\.[a-z0-9]+$"), F.concat(h, F.lit(".jpg"))).otherwise(h)
    return F.when(name == "", F.lit("")).otherwise(
        F.concat(F.lit(K.PMC_ARTICLE_BASE), _s(pmcid), F.lit("/bin/"), name))


# -- predicates F05-F14 -------------------------------------------------------

def is_blocked_text(text) -> Column:
    """any bot-challenge marker in the lower-cased text."""
    t = F.lower(_s(text))
    return any_of([t.contains(m) for m in K.BLOCK_TEXT_MARKERS])


def is_blocked_host(url, hosts=None) -> Column:
    """case-sensitive substring match on a blocked host."""
    u = _s(url)
    return any_of([u.contains(h) for h in (hosts or K.BLOCKED_HOSTS)])


def is_data_repository_url(url) -> Column:
    """lower-cased URL contains a data-repository host fragment."""
    u = F.lower(_s(url))
    return any_of([u.contains(h) for h in K.DATA_REPOSITORY_HOSTS])


def record_is_dataset(url, kind) -> Column:
    """F09."""
    return is_data_repository_url(url) | F.lower(_s(kind)).contains("dataset")


def is_data_file_url(url) -> Column:
    """path extension in the data-file extension set.

    An extension stands in the URL as it is, unless it is percent-encoded or lower-cases from beyond ASCII:
    one pattern spares most URLs the decoding.
    """
    some = "[%.[^\\x00-\\x7F]](?:(?<!\\.)|(?i:" + "|".join(e.lstrip(".") for e in K.DATA_FILE_EXTENSIONS) + "))"
    return _s(url).rlike(some) & path_extension(url).isin(K.DATA_FILE_EXTENSIONS)


def repository_href(raw_href, hosts=None) -> Column:
    """raw href contains a repository host, case-sensitive."""
    h = _s(raw_href)
    return any_of([h.contains(x) for x in (hosts or K.DATA_REPOSITORY_HOSTS)])


def is_site_chrome_link(raw_href, text) -> Column:
    """site-chrome links that match the host list but are not data."""
    alts = "|".join(K.SITE_CHROME_LINK_TEXTS)
    return (_s(raw_href).rlike(r"mendeley\.com/import")
            | _s(raw_href).rlike(r"(?i)github\.com/ncbi")
            | _s(text).rlike(f"(?i)^({alts})$"))


DOWNLOAD_TEXT_RE = WB_BEFORE + "(?i:(" + "|".join(K.DOWNLOAD_LINK_WORDS) + "))" + WB_AFTER


def is_download_link(url, text) -> Column:
    """data-file URL or download-ish link text."""
    return is_data_file_url(url) | _s(text).rlike(DOWNLOAD_TEXT_RE)
