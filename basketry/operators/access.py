"""Accounts and access: sign-up rules and conflicts, roles and privileges,
gateway routing, error maps and outcome counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions.columns import email_ok, is_blank, length_between
from basketry.operators.scan import materialize
from basketry.schemas import (DEFAULT_ROLE, GRANT_RULES, OPEN_PATHS, PRIVILEGES, error_codes_df, literal_df,
                              privileges_df, roles_df)

# field rules of a registration, in annotation order: (field, failed-when, message)
_SIZE = "size must be between {} and {}"


def _rules() -> list[tuple[str, Column, str]]:
    e, u, p = F.col("email"), F.col("username"), F.col("password")
    return [
        ("email", is_blank(e), "must not be blank"),
        ("email", ~is_blank(e) & ~email_ok(e), "must be a well-formed email address"),
        ("email", F.char_length(e) > 100, _SIZE.format(0, 100)),
        ("username", is_blank(u), "must not be blank"),
        ("username", ~length_between(u, 3, 50), _SIZE.format(3, 50)),
        ("password", is_blank(p), "must not be blank"),
        ("password", ~length_between(p, 8, 100), _SIZE.format(8, 100)),
    ]


def _request_rules() -> dict[str, list[tuple[str, Column, str]]]:
    """The field rules of each kind of request, in annotation order."""
    blank = lambda c: (c, is_blank(F.col(c)), "must not be blank")
    e = F.col("email")
    return {
        "register": _rules(),
        "login": [blank("email"), ("email", ~is_blank(e) & ~email_ok(e), "must be a well-formed email address"), blank("password")],
        "refresh": [blank("refresh_token")], "logout": [blank("refresh_token")],
        "add_item": [blank("barcode")], "gate": [blank("correlation_id")],
    }


def _errors(rules: list[tuple[str, Column, str]]) -> Column:
    """Field errors in rule order, "field: message", comma separated ('' if none)."""
    return F.concat_ws(", ", *[F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{f}: {m}")) for f, bad, m in rules])


def _field_map(rules: list[tuple[str, Column, str]], last_wins: bool = False) -> Column:
    """Field -> message as a JSON object. Of several messages of a field the
    first stays (the auth service's merge rule) or the last (the cart's)."""
    fields: dict[str, list[Column]] = {}
    for f, bad, m in rules:
        fields.setdefault(f, []).append(F.when(F.coalesce(bad, F.lit(False)), F.lit(f'"{f}":"{m}"')))
    entries = [F.coalesce(*(hits[::-1] if last_wins else hits)) for hits in fields.values()]
    return F.concat(F.lit("{"), F.concat_ws(",", *entries), F.lit("}"))


def validate_requests(req: DataFrame) -> DataFrame:
    """P13 for sign-ups: field errors per request and a valid flag — one
    projection, no shuffle."""
    joined = _errors(_rules())
    return req.select("request_id", "email", "username", (joined == "").alias("valid"),
                      F.when(joined != "", joined).alias("errors"))


def validate_all_requests(req: DataFrame) -> DataFrame:
    """P13 and A5 for all kinds of request (``kind``: register, login, refresh,
    logout, add_item, gate): field errors, valid flag and the error map of the
    service that answers (the cart's map keeps a field's last message). One
    projection, no shuffle."""
    errs = maps = None
    for kind, rules in _request_rules().items():
        if not {f for f, _, _ in rules} <= set(req.columns):
            continue   # the table holds no requests of this kind
        here = F.col("kind") == kind
        err, fmap = _errors(rules), _field_map(rules, last_wins=kind == "add_item")
        errs = F.when(here, err) if errs is None else errs.when(here, err)
        maps = F.when(here, fmap) if maps is None else maps.when(here, fmap)
    out = req.select("request_id", "kind", errs.alias("_e"), maps.alias("_m"))
    return out.select("request_id", "kind", (F.col("_e") == "").alias("valid"), F.when(F.col("_e") != "", F.col("_e")).alias("errors"),
                      F.when(F.col("_e") != "", F.col("_m")).alias("field_errors"))


def error_map(req: DataFrame) -> DataFrame:
    """A5 for sign-ups: field -> message, first message per field wins."""
    return req.select("request_id", _field_map(_rules()).alias("field_errors")).where(F.col("field_errors") != "{}")


def lookup_by_key(requests: DataFrame, request_key: str, table: DataFrame, key: str, name: str) -> DataFrame:
    """P8 for any unique key: (lookup, request_key, found) per request."""
    t = table.select(F.col(key).cast("string").alias("request_key"), F.lit(True).alias("_hit"))
    return (requests.select(F.col(request_key).cast("string").alias("request_key")).join(t, "request_key", "left")
            .select(F.lit(name).alias("lookup"), "request_key", F.coalesce("_hit", F.lit(False)).alias("found")))


def _first_two(rows: DataFrame, key: str) -> DataFrame:
    """(key, first, second): the two smallest request ids of each key; a hot key is cut to two rows before the exchange."""
    w = Window.partitionBy(key).orderBy("request_id")
    two = rows.select(key, "request_id").withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    return two.groupBy(key).agg(F.min(F.when(F.col("_n") == 1, F.col("request_id"))).alias(f"{key}_1"),
                                F.min(F.when(F.col("_n") == 2, F.col("request_id"))).alias(f"{key}_2"))


def _accepted(open_rows: DataFrame) -> list[DataFrame]:
    """The sign-ups that are registered of rows (request_id, email, username) that
    collide with each other only, as parts.

    A row waits for earlier undecided rows of its e-mail and of its user name. A
    row that waits for none is registered. A row that waits for exactly one is
    registered if and only if that one is not, so along a chain of such rows
    the fate alternates: the distance to the chain's head is found by pointer
    doubling, in as many joins as the log of the longest chain. Rows that wait
    for several come in the next round; most have lost to a decided row by then."""
    parts: list[DataFrame] = []
    rid = F.col("request_id")
    while not open_rows.isEmpty():
        j = open_rows.join(_first_two(open_rows, "email"), "email").join(_first_two(open_rows, "username"), "username")
        first = {k: rid == F.col(f"{k}_1") for k in ("email", "username")}
        second = {k: rid == F.col(f"{k}_2") for k in ("email", "username")}
        one = (F.when(first["email"] & second["username"], F.col("username_1")).when(second["email"] & first["username"], F.col("email_1"))
               .when(second["email"] & second["username"] & (F.col("email_1") == F.col("username_1")), F.col("email_1")))
        nodes = materialize(j.select("request_id", "email", "username", (first["email"] & first["username"]).alias("_head"), one.alias("_to")))
        heads = nodes.where("_head").select("request_id", "email", "username")
        links = nodes.where("_to is not null").select("request_id", "email", "username", "_to", F.lit(1).alias("_odd"))
        moving = not links.isEmpty()
        while moving:
            step = links.select(F.col("request_id").alias("_to"), F.col("_to").alias("_next"), F.col("_odd").alias("_more"))
            links = materialize(links.join(step, "_to", "left").select(
                "request_id", "email", "username", F.coalesce("_next", "_to").alias("_to"),
                ((F.col("_odd") + F.coalesce("_more", F.lit(0))) % 2).alias("_odd"), F.col("_next").isNotNull().alias("_moved")))
            moving = not links.where("_moved").isEmpty()
        settled = links.join(heads.select(F.col("request_id").alias("_to")), "_to", "left_semi")
        new = materialize(heads.unionByName(settled.where("_odd = 0").select("request_id", "email", "username")))
        parts.append(new)
        rest = nodes.where("not _head").select("request_id", "email", "username")
        rest = rest.join(settled.where("_odd = 1").select("request_id"), "request_id", "left_anti")
        open_rows = materialize(rest.join(new.select("email"), "email", "left_anti").join(new.select("username"), "username", "left_anti"))
    return parts


def registration_outcomes(spark: SparkSession, req: DataFrame, users: DataFrame) -> DataFrame:
    """P12 core: outcome per sign-up, processed in request order as the service
    does: invalid -> 400; e-mail taken (existing user, or an earlier sign-up
    of this batch that was registered) -> 409; then user name taken -> 409;
    else registered.

    Exact and distributed: rows that stored users decide are settled first, the
    registered ones among the rest are found by ``_accepted``, and one join with
    those gives every refused row its reason."""
    v = validate_requests(req).select("request_id", "email", "username", "valid")
    ex_e = users.select("email").distinct().withColumn("email_exists", F.lit(True))
    ex_u = users.select("username").distinct().withColumn("username_exists", F.lit(True))
    r = materialize(v.join(ex_e, "email", "left").join(ex_u, "username", "left"))
    known = F.when(~F.col("valid"), "invalid").when(F.col("email_exists"), "email_taken")
    open_rows = r.where(known.isNull() & F.col("username_exists").isNull()).select("request_id", "email", "username")
    registered = None
    for part in _accepted(open_rows):
        registered = part if registered is None else registered.unionByName(part)
    if registered is None:
        registered = open_rows.where("false")
    by_email = registered.select("email", F.col("request_id").alias("_email_of"))
    mine = registered.select("request_id", F.lit(True).alias("_mine"))
    j = r.join(by_email, "email", "left").join(mine, "request_id", "left")
    outcome = (known.when(F.col("_mine"), "registered").when(F.col("_email_of") < F.col("request_id"), "email_taken").otherwise("username_taken"))
    return j.select("request_id", "email", "username", outcome.alias("outcome"))


def registration_conflicts(spark: SparkSession, req: DataFrame, users: DataFrame) -> DataFrame:
    """The sign-ups that collide, e-mail checked before user name."""
    o = registration_outcomes(spark, req, users)
    return (o.where(F.col("outcome").isin("email_taken", "username_taken"))
             .select("request_id", "email", "username",
                     F.when(F.col("outcome") == "email_taken", "Email already registered")
                      .otherwise("Username already taken").alias("reason")))


def register_batch(spark: SparkSession, req: DataFrame, users: DataFrame) -> DataFrame:
    """Accepted sign-ups become user rows with the default role and
    created_at; rejected rows carry the reason. The password is never kept."""
    o = registration_outcomes(spark, req, users)
    t = req.select("request_id", "requested_at")
    j = o.join(t, "request_id")
    ok = F.col("outcome") == "registered"
    return j.select("request_id", "email", "username", "outcome",
                    F.when(ok, F.lit(DEFAULT_ROLE)).alias("role"),
                    F.when(ok, F.col("requested_at")).alias("created_at"),
                    F.when(ok, F.lit(True)).alias("enabled"),
                    F.when(F.col("outcome") == "email_taken", "Email already registered")
                     .when(F.col("outcome") == "username_taken", "Username already taken")
                     .when(~ok, "Validation failed").alias("reason"))


def lookup_by_unique_key(req: DataFrame, users: DataFrame) -> DataFrame:
    """Unique lookup (here: login e-mail -> user) with a found flag."""
    u = users.select("email", F.col("id").alias("user_id"))
    j = req.select("request_id", "email").join(u, "email", "left")
    return j.select("request_id", "email", "user_id", F.col("user_id").isNotNull().alias("found"))


def _grants(spark: SparkSession) -> DataFrame:
    """The grant table (role, privilege) from the fixed rules; '*' = all."""
    rows = [(r, p) for r, ps in GRANT_RULES for p in (PRIVILEGES if ps == ["*"] else ps)]
    return literal_df(spark, rows, "role_name string, privilege_name string")


def user_privileges(spark: SparkSession, users: DataFrame) -> DataFrame:
    """User -> role -> privileges as flat rows. Every join but the users
    side is a fixed literal table, so all are broadcast: users stream through
    without a shuffle."""
    roles = roles_df(spark)
    g = (_grants(spark).join(roles, "role_name")
                       .join(privileges_df(spark), "privilege_name"))
    u = users.select(F.col("id").alias("user_id"), F.col("role").alias("role_name"))
    return u.join(F.broadcast(g), "role_name", "left").select(
        "user_id", "role_name", "role_id", "privilege_id", "privilege_name")


def role_privilege_grants(spark: SparkSession, users: DataFrame) -> DataFrame:
    """The role x privilege grants with the number of users holding each."""
    n = users.groupBy(F.col("role").alias("role_name")).agg(F.count(F.lit(1)).alias("n_users"))
    g = _grants(spark)
    return g.join(n, "role_name", "left").select(
        "role_name", "privilege_name", F.coalesce(F.col("n_users"), F.lit(0)).alias("n_users"))


def grant_union(spark: SparkSession, users: DataFrame) -> DataFrame:
    """The three grant branches (customer, worker, admin = all) built
    separately and unioned into roles_privileges, with users per grant."""
    roles, privs = roles_df(spark), privileges_df(spark)
    branches = []
    for role, ps in GRANT_RULES:
        r = roles.where(F.col("role_name") == role)
        p = privs if ps == ["*"] else privs.where(F.col("privilege_name").isin(*ps))
        p = p.withColumn("role_name", F.lit(role))
        branches.append(r.join(F.broadcast(p), "role_name"))
    u = branches[0]
    for b in branches[1:]:
        u = u.unionByName(b)
    n = users.groupBy(F.col("role").alias("role_name")).agg(F.count(F.lit(1)).alias("n_users"))
    return u.join(n, "role_name", "left").select(
        "role_id", "privilege_id", F.coalesce(F.col("n_users"), F.lit(0)).alias("n_users"))


def cascade_delete(users: DataFrame, tokens: DataFrame) -> DataFrame:
    """Deleting users (here: those whose e-mail fails the format rule)
    removes their role bridge rows and refresh tokens; the surviving child
    rows are returned."""
    gone = users.where(~email_ok("email")).select(F.col("id").alias("user_id"))
    bridge = users.select(F.col("id").alias("user_id"), F.col("role").alias("child_key")) \
                  .withColumn("table_name", F.lit("users_roles"))
    toks = tokens.select("user_id", F.col("token").alias("child_key")).withColumn("table_name",
                                                                                F.lit("refresh_tokens"))
    return bridge.unionByName(toks).join(gone, "user_id", "left_anti")


def route_requests(spark: SparkSession, access: DataFrame) -> DataFrame:
    """Route of each request path; a rule prefix matches the path itself or
    prefix + '/...'; longest prefix wins; else unrouted.

    The six rules are fixed, so they are one CASE over the path, longest prefix
    first: a narrow projection inside codegen, no join and no shuffle."""
    from basketry.schemas import ROUTES
    path, route = F.col("path"), None
    for name, prefix in sorted(ROUTES, key=lambda r: -len(r[1])):
        hit = (path == prefix) | path.startswith(prefix + "/")
        route = F.when(hit, name) if route is None else route.when(hit, name)
    return access.select("event_id", "path", route.otherwise("unrouted").alias("route_id"))


def open_path_filter(access: DataFrame) -> DataFrame:
    """Paths exempt from the token check."""
    p = F.col("path")
    is_open = F.lit(False)
    for o in OPEN_PATHS:
        is_open = is_open | p.startswith(o)
    return access.select("event_id", "path", is_open.alias("open"))


def outcome_counts(spark: SparkSession, parts: dict[str, DataFrame]) -> DataFrame:
    """Rejected work by error code and HTTP status. ``parts`` maps an
    outcome source to rows with an ``exception`` column (null = accepted) and,
    if they come from several, a ``source`` column; counts are
    partial aggregates joined to the 13-row code table."""
    u = None
    for name, df in parts.items():
        source = F.col("source") if "source" in df.columns else F.lit(name)
        d = df.select(source.alias("source"), "exception").where(F.col("exception").isNotNull())
        u = d if u is None else u.unionByName(d)
    c = u.groupBy("source", "exception").agg(F.count(F.lit(1)).alias("n"))
    codes = error_codes_df(spark)
    svc = {"signups": "auth", "refresh": "auth", "logout": "auth", "cart_access": "cart", "scans": "cart", "removes": "cart",
           "gates": "session", "replay": "session", "owners": "session", "fields": "auth", "cart_fields": "cart", "logins": "auth"}
    c = c.withColumn("service", F.element_at(F.create_map(*[x for k, v in svc.items()
                                                            for x in (F.lit(k), F.lit(v))]), F.col("source")))
    return (c.join(codes, ["service", "exception"])
             .groupBy("service", "code", "http_status").agg(F.sum("n").alias("n")))


def _exc(col: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out


def outcome_sources(spark: SparkSession, v, secret: str) -> dict[str, DataFrame]:
    """The outcome rows A6 counts, each mapped to the exception it raises."""
    from basketry.operators import carts
    from basketry.operators import sessions as sess
    from basketry.operators import tokens as tok
    reg = registration_outcomes(spark, v.signups, v.users).select(
        _exc(F.col("outcome"), {"invalid": "MethodArgumentNotValidException",
                                "email_taken": "DuplicateResourceException",
                                "username_taken": "DuplicateResourceException"}).alias("exception"))
    ref = tok.refresh_outcomes(v.token_log, v.tokens).select(
        _exc(F.col("outcome"), {"invalid": "InvalidTokenException", "expired": "InvalidTokenException",
                                "reuse": "TokenReuseException"}).alias("exception"))
    out = tok.logout_revocation(v.token_log, v.tokens).select(
        F.when(F.col("outcome") == "invalid", "InvalidTokenException").alias("exception"))
    cart = sess.session_access_check(
        v.access_requests, v.sessions).select(F.when(~F.col("valid"), "InvalidSessionException").alias("exception"))
    gates = sess.gate_history(v.gate_requests, v.gate_tokens, v.gate_sessions, secret).where(F.col("gate") == "entry").select(
        _exc(F.col("result"), {"not_found": "InvalidQrTokenException", "not_active": "InvalidQrTokenException",
                               "bad_signature": "InvalidQrTokenException", "expired": "QrTokenExpiredException",
                               "illegal_transition": "IllegalStateTransitionException"}).alias("exception"))
    rep = sess.session_replay(v.session_log).select(
        F.when(~F.col("accepted"), "IllegalStateTransitionException").alias("exception"))
    scans = carts.enrich_scans(v.barcode_requests, v.catalog).select(
        F.when(F.col("outcome") != "ok", "ProductNotFoundException").alias("exception"))
    removes = carts.cart_running_quantity(v.cart_events).select(
        F.when(F.col("rejected"), "CartItemNotFoundException").alias("exception"))
    fields = v.field_requests
    # one pass for the kinds of both services
    bad = validate_all_requests(fields.where(F.col("kind").isin("login", "refresh", "logout", "add_item"))).where("not valid").select(
        F.when(F.col("kind") == "add_item", "cart_fields").otherwise("fields").alias("source"), F.lit("MethodArgumentNotValidException").alias("exception"))
    logins = fields.where((F.col("kind") == "login") & ~is_blank(F.col("password")) & email_ok("email")).join(
        v.users.select("email"), "email", "left_anti").select(F.lit("BadCredentialsException").alias("exception"))
    owners = sess.verify_owner(v.owner_requests, v.sessions).select(
        F.when(~F.col("visible"), "SessionNotFoundException").alias("exception"))
    return {"signups": reg, "refresh": ref, "logout": out, "cart_access": cart, "scans": scans, "removes": removes,
            "gates": gates, "replay": rep, "owners": owners, "fields": bad, "logins": logins}

