"""Named queries: each takes (spark, sf_dir) and returns a DataFrame over the
driver tables (through the adapter views). ``oracle.py`` holds the SQL twin of
each one that is SQL-expressible."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import cart_history, carts, sessions as sess
from basketry.functions.columns import sha256_hex
from basketry.sources import fixtures
from basketry.sources.fixtures import QR_SECRET
from basketry.sources.tables import Views, damaged_audit

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _v(spark, sf_dir) -> Views:
    return Views(spark, sf_dir)


# --- carts -------------------------------------------------------------------------

@query("cart_totals")
def q_cart_totals(spark, sf_dir):
    return carts.cart_totals(_v(spark, sf_dir).cart_lines)


@query("scan_merge")
def q_scan_merge(spark, sf_dir):
    return carts.scan_merge(_v(spark, sf_dir).cart_lines)


@query("cart_snapshot")
def q_cart_snapshot(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_snapshot(v.sessions, v.cart_lines)


@query("sorted_cart_lines")
def q_sorted_cart_lines(spark, sf_dir):
    return carts.sorted_cart_lines(_v(spark, sf_dir).cart_lines)


@query("cart_item_view")
def q_cart_item_view(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_item_view(v.cart_lines, v.catalog)


@query("cart_lines_by_session")
def q_cart_lines_by_session(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_lines_by_session(v.access_log, v.cart_lines)


@query("cart_line_by_session_product")
def q_cart_line_by_session_product(spark, sf_dir):
    v = _v(spark, sf_dir)
    asked = v.cart_lines.select("session_id", F.when(F.col("session_id") % 3 == 0, F.lit("0000000000000"))
                                .otherwise(F.col("barcode")).alias("barcode")).distinct()
    return carts.cart_line_by_session_product(asked, v.cart_lines)


@query("enrich_scans")
def q_enrich_scans(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.enrich_scans(v.barcode_requests, v.full_products)


@query("cart_running_quantity")
def q_cart_running_quantity(spark, sf_dir):
    return carts.cart_running_quantity(_v(spark, sf_dir).cart_events)


@query("price_at_addition")
def q_price_at_addition(spark, sf_dir):
    return carts.price_at_addition(_v(spark, sf_dir).cart_events)


@query("price_drift")
def q_price_drift(spark, sf_dir):
    return carts.price_drift(_v(spark, sf_dir).cart_events)


@query("cart_change_feed")
def q_cart_change_feed(spark, sf_dir):
    return carts.cart_change_feed(_v(spark, sf_dir).cart_events)


@query("cart_read_through")
def q_cart_read_through(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_read_through(v.cart_events, v.cart_lines)


@query("cart_ttl_view")
def q_cart_ttl_view(spark, sf_dir):
    return carts.cart_ttl_view(_v(spark, sf_dir).cart_events)


@query("cart_as_of")
def q_cart_as_of(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_as_of(v.cart_reads, v.cart_events)


@query("cart_read_through_as_of")
def q_cart_read_through_as_of(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.cart_read_through_as_of(v.cart_reads, v.cart_events)


@query("delete_by_key")
def q_delete_by_key(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.delete_by_key(v.cart_events, v.cart_lines)


def help_events(v):
    """Help requests raised by a user in their own (first) session."""
    first = v.sessions.groupBy(F.col("user_id").alias("_u")).agg(F.min("session_id").alias("_s"))
    ev = v.cart_events
    return (ev.join(first, ev.session_id == first._u, "left")
              .withColumn("session_id", F.coalesce(F.col("_s"), F.lit(-1).cast("bigint"))).drop("_u", "_s"))


@query("accepted_help_requests")
def q_accepted_help_requests(spark, sf_dir):
    v = _v(spark, sf_dir)
    return carts.accepted_help_requests(help_events(v), v.access_log, v.sessions)


# --- sessions ----------------------------------------------------------------------

SESSIONS_AS_OF = "1998-04-15 00:00:00"
LOG_AS_OF = "2024-01-30 00:00:00"


@query("transition_check")
def q_transition_check(spark, sf_dir):
    return sess.transition_check(spark, sess.naive_chain(_v(spark, sf_dir).session_log))


@query("illegal_edges")
def q_illegal_edges(spark, sf_dir):
    return sess.illegal_edges(spark, sess.naive_chain(_v(spark, sf_dir).session_log))


@query("session_replay")
def q_session_replay(spark, sf_dir):
    return sess.session_replay(_v(spark, sf_dir).session_log)


@query("transition_chain_audit")
def q_transition_chain_audit(spark, sf_dir):
    return sess.transition_chain_audit(spark, damaged_audit(sess.transition_audit(_v(spark, sf_dir).session_log)))


@query("state_dwell_time")
def q_state_dwell_time(spark, sf_dir):
    return sess.state_dwell_time(sess.transition_audit(_v(spark, sf_dir).session_log))


@query("stuck_payments")
def q_stuck_payments(spark, sf_dir):
    return sess.stuck_payments(_v(spark, sf_dir).session_log, LOG_AS_OF)


@query("payment_receipts")
def q_payment_receipts(spark, sf_dir):
    return sess.payment_receipts(_v(spark, sf_dir).session_log, QR_SECRET)


@query("issue_tokens")
def q_issue_tokens(spark, sf_dir):
    return sess.issue_tokens(_v(spark, sf_dir).sessions, QR_SECRET)


@query("resolve_user")
def q_resolve_user(spark, sf_dir):
    return sess.resolve_user(_v(spark, sf_dir).access_log)


@query("start_sessions")
def q_start_sessions(spark, sf_dir):
    return sess.start_sessions(_v(spark, sf_dir).access_log, QR_SECRET)


@query("validate_tokens")
def q_validate_tokens(spark, sf_dir):
    v = _v(spark, sf_dir)
    return sess.validate_tokens(v.gate_requests, v.gate_tokens, QR_SECRET)


def gate_history(v):
    return sess.gate_history(v.gate_requests, v.gate_tokens, v.gate_sessions, QR_SECRET)


@query("gate_entry")
def q_gate_entry(spark, sf_dir):
    return sess.gate_entry(gate_history(_v(spark, sf_dir)))


@query("gate_exit")
def q_gate_exit(spark, sf_dir):
    return sess.gate_exit(gate_history(_v(spark, sf_dir)))


@query("session_access_check")
def q_session_access_check(spark, sf_dir):
    v = _v(spark, sf_dir)
    return sess.session_access_check(v.access_requests.drop("event_time"), v.sessions)


@query("verify_owner")
def q_verify_owner(spark, sf_dir):
    v = _v(spark, sf_dir)
    return sess.verify_owner(v.owner_requests, v.sessions)


@query("exit_token_eligibility")
def q_exit_token_eligibility(spark, sf_dir):
    v = _v(spark, sf_dir)
    return sess.exit_token_eligibility(v.access_requests.drop("user_text"), v.sessions, QR_SECRET)


@query("session_view")
def q_session_view(spark, sf_dir):
    return sess.session_view(_v(spark, sf_dir).sessions)


@query("sessions_by_user_status")
def q_sessions_by_user_status(spark, sf_dir):
    v = _v(spark, sf_dir)
    return sess.sessions_by_user_status(v.users, v.sessions)


@query("expired_sessions")
def q_expired_sessions(spark, sf_dir):
    return sess.expired_sessions(_v(spark, sf_dir).sessions, SESSIONS_AS_OF)


# --- tokens ------------------------------------------------------------------------

from basketry.operators import tokens as tok  # noqa: E402


@query("refresh_outcomes")
def q_refresh_outcomes(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.refresh_outcomes(v.token_log, v.tokens)


@query("reuse_detection")
def q_reuse_detection(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.reuse_detection(v.token_log, v.tokens)


@query("logout_revocation")
def q_logout_revocation(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.logout_revocation(v.token_log, v.tokens)


@query("family_revoke")
def q_family_revoke(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.family_revoke(v.token_log, v.tokens)


@query("revoked_per_family")
def q_revoked_per_family(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.revoked_per_family(v.token_log, v.tokens)


@query("rotation_lineage")
def q_rotation_lineage(spark, sf_dir):
    return tok.rotation_lineage(_v(spark, sf_dir).tokens)


@query("issue_refresh_tokens")
def q_issue_refresh_tokens(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.issue_refresh_tokens(v.access_log, v.token_log, v.tokens)


@query("token_with_session")
def q_token_with_session(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.token_with_session(v.qr_tokens, v.sessions, v.tokens, v.users, sess.gate_entry(gate_history(v)).where("token_used"))


@query("tokens_by_family")
def q_tokens_by_family(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.tokens_by_family(v.token_log, v.tokens)


@query("hash_tokens")
def q_hash_tokens(spark, sf_dir):
    return tok.hash_tokens(_v(spark, sf_dir).tokens)


@query("sign_verify")
def q_sign_verify(spark, sf_dir):
    return tok.sign_verify(fixtures.stored_qr_tokens(_v(spark, sf_dir).qr_tokens), QR_SECRET)


@query("parse_price")
def q_parse_price(spark, sf_dir):
    return tok.parse_prices(fixtures.price_texts(_v(spark, sf_dir).part))


@query("token_audit")
def q_token_audit(spark, sf_dir):
    v = _v(spark, sf_dir)
    return tok.token_audit(fixtures.bearer_headers(v.access_log, v.users), fixtures.JWT_SECRET)


# --- access ------------------------------------------------------------------------

from basketry.operators import access as acc  # noqa: E402


@query("validate_requests")
def q_validate_requests(spark, sf_dir):
    return acc.validate_requests(_v(spark, sf_dir).signups)


@query("validate_all_requests")
def q_validate_all_requests(spark, sf_dir):
    return acc.validate_all_requests(_v(spark, sf_dir).field_requests)


@query("lookups_by_key")
def q_lookups_by_key(spark, sf_dir):
    v = _v(spark, sf_dir)
    shown = v.token_log.select(sha256_hex("token").alias("h"))
    stored = tok.hash_tokens(v.tokens)
    roles = acc.roles_df(spark)
    return (acc.lookup_by_key(shown, "h", stored, "token_hash", "token_hash")
            .unionByName(acc.lookup_by_key(v.gate_requests, "correlation_id", v.gate_tokens, "correlation_id", "correlation_id"))
            .unionByName(acc.lookup_by_key(v.access_log, "header_user_id", v.users, "id", "user_id"))
            .unionByName(acc.lookup_by_key(v.users, "role", roles, "role_name", "role_name")))


@query("session_access_check_uuid")
def q_session_access_check_uuid(spark, sf_dir):
    """J2 with the ids the service has: UUID text, any case."""
    v = _v(spark, sf_dir)
    of = lambda c: sess.uuid_from(F.concat(F.lit("session:"), c.cast("string")))
    sessions = v.sessions.withColumn("session_id", of(F.col("session_id")))
    text = F.col("session_text")
    asked = v.access_requests.drop("event_time").withColumn("session_text", F.when(text == "x", text).when(
        F.col("event_id") % 2 == 0, F.upper(of(text))).otherwise(of(text)))
    return sess.session_access_check(asked, sessions, id_format="uuid")


@query("error_map")
def q_error_map(spark, sf_dir):
    return acc.error_map(_v(spark, sf_dir).signups)


@query("registration_conflicts")
def q_registration_conflicts(spark, sf_dir):
    v = _v(spark, sf_dir)
    return acc.registration_conflicts(spark, v.signups, v.users)


@query("register_batch")
def q_register_batch(spark, sf_dir):
    v = _v(spark, sf_dir)
    return acc.register_batch(spark, v.signups, v.users)


@query("lookup_by_unique_key")
def q_lookup_by_unique_key(spark, sf_dir):
    v = _v(spark, sf_dir)
    return acc.lookup_by_unique_key(v.signups, v.users)


@query("user_privileges")
def q_user_privileges(spark, sf_dir):
    return acc.user_privileges(spark, _v(spark, sf_dir).users)


@query("role_privilege_grants")
def q_role_privilege_grants(spark, sf_dir):
    return acc.role_privilege_grants(spark, _v(spark, sf_dir).users)


@query("grant_union")
def q_grant_union(spark, sf_dir):
    return acc.grant_union(spark, _v(spark, sf_dir).users)


@query("cascade_delete")
def q_cascade_delete(spark, sf_dir):
    v = _v(spark, sf_dir)
    return acc.cascade_delete(v.users, v.tokens)


@query("route_requests")
def q_route_requests(spark, sf_dir):
    return acc.route_requests(spark, _v(spark, sf_dir).access_log)


@query("open_path_filter")
def q_open_path_filter(spark, sf_dir):
    return acc.open_path_filter(_v(spark, sf_dir).access_log)


@query("outcome_counts")
def q_outcome_counts(spark, sf_dir):
    return acc.outcome_counts(spark, acc.outcome_sources(spark, _v(spark, sf_dir), QR_SECRET))


# --- catalog -----------------------------------------------------------------------

from basketry.operators import catalog as cat, containment  # noqa: E402
from basketry.sources.relations import attribute_view  # noqa: E402

SEARCH_QUERY = "red"


@query("product_by_barcode")
def q_product_by_barcode(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.product_by_barcode(v.barcode_requests, v.catalog)


@query("products_by_barcodes")
def q_products_by_barcodes(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.products_by_barcodes(v.barcode_requests, v.catalog)


@query("product_search")
def q_product_search(spark, sf_dir):
    return cat.product_search(_v(spark, sf_dir).catalog, SEARCH_QUERY)


@query("first_page")
def q_first_page(spark, sf_dir):
    return cat.first_page(_v(spark, sf_dir).catalog)


@query("product_dto")
def q_product_dto(spark, sf_dir):
    return cat.product_dto(_v(spark, sf_dir).full_products)


@query("product_nutrition")
def q_product_nutrition(spark, sf_dir):
    return cat.product_nutrition(_v(spark, sf_dir).full_products)


@query("product_wire_row")
def q_product_wire_row(spark, sf_dir):
    return cat.product_wire_row(_v(spark, sf_dir).catalog)


@query("trigram_search")
def q_trigram_search(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.trigram_search(v.search_requests, v.catalog)


@query("top_n_per_query")
def q_top_n_per_query(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.top_n_per_query(v.search_requests, v.catalog)


@query("product_json_normalize")
def q_product_json_normalize(spark, sf_dir):
    return cat.product_json_normalize(_v(spark, sf_dir).raw_products)


@query("apply_defaults")
def q_apply_defaults(spark, sf_dir):
    return cat.apply_defaults(_v(spark, sf_dir).partial_rows)


@query("catalog_fallback")
def q_catalog_fallback(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.catalog_fallback(v.barcode_requests, v.catalog, v.raw_products)


@query("seed_dimensions")
def q_seed_dimensions(spark, sf_dir):
    return cat.seed_dimensions(spark, _v(spark, sf_dir).catalog)


@query("upsert_by_key")
def q_upsert_by_key(spark, sf_dir):
    v = _v(spark, sf_dir)
    at = lambda t: F.expr(f"TIMESTAMP_NTZ'{t} 00:00:00'")
    stored = v.catalog.withColumns({"created_at": at("2023-01-01"), "updated_at": at("2023-06-01")})
    return cat.upsert_by_key(stored, v.price_updates, at("2024-01-01"))


@query("assign_surrogate_ids")
def q_assign_surrogate_ids(spark, sf_dir):
    v = _v(spark, sf_dir)
    new = cat.write_through(v.barcode_requests, v.catalog, v.raw_products).select("barcode", "name")
    ids = v.catalog.select((F.col("barcode").cast("bigint") + 1).alias("id"))
    return cat.assign_surrogate_ids(spark, new, ids)


@query("category_tree")
def q_category_tree(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.category_tree(spark, cat.tree_nodes(v.region, v.nation, v.customer))


@query("attribute_filter")
def q_attribute_filter(spark, sf_dir):
    v = _v(spark, sf_dir)
    return cat.attribute_filter(cat.attribute_requests(v.supplier, v.part), v.catalog)


@query("attribute_containment")
def q_attribute_containment(spark, sf_dir):
    return containment.contained(attribute_view(spark, sf_dir, "attribute_wants"), attribute_view(spark, sf_dir, "rich_products"))


@query("catalog_by_aisle_category")
def q_catalog_by_aisle_category(spark, sf_dir):
    return cat.catalog_by_aisle_category(_v(spark, sf_dir).catalog)


# --- quality, scans and topics -----------------------------------------------------

from basketry.operators import quality as qual  # noqa: E402
from basketry.sources import topics  # noqa: E402
from basketry.sources.relations import relations  # noqa: E402
from basketry.sources.tables import DRIVER_TABLES, read_table  # noqa: E402


@query("unique_violations")
def q_unique_violations(spark, sf_dir):
    return qual.unique_violations(relations(spark, sf_dir))


@query("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    return qual.fk_orphans(relations(spark, sf_dir))


@query("domain_violations")
def q_domain_violations(spark, sf_dir):
    return qual.domain_violations(relations(spark, sf_dir))


@query("cascade_graph")
def q_cascade_graph(spark, sf_dir):
    r = relations(spark, sf_dir)
    return qual.cascade(r, {"users": r["users"].where("email is null or not contains(email, '@')").select("id"),
                            "roles": r["roles"].where("id % 9 = 0").select("id"), "privileges": r["privileges"].where("id % 4 = 2").select("id")})


@query("schema_evolve")
def q_schema_evolve(spark, sf_dir):
    return qual.schema_evolve(_v(spark, sf_dir).landed_catalog)


@query("latest_version")
def q_latest_version(spark, sf_dir):
    return qual.latest_version(fixtures.version_log(_v(spark, sf_dir).cart_lines))


@query("scan_tables")
def q_scan_tables(spark, sf_dir):
    out = None
    for t in DRIVER_TABLES:
        c = read_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit(t).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def _feed(spark, v):
    fold = carts.cart_running_quantity(v.cart_events)
    helps = carts.accepted_help_requests(help_events(v), v.access_log, v.sessions)
    return topics.encode_events(fold, v.catalog, helps, sess.payment_receipts(v.session_log, QR_SECRET))


@query("encode_events")
def q_encode_events(spark, sf_dir):
    return _feed(spark, _v(spark, sf_dir))


@query("decode_topics")
def q_decode_topics(spark, sf_dir):
    return topics.decode_topics(fixtures.corrupt_some(_feed(spark, _v(spark, sf_dir))))


# --- streaming ---------------------------------------------------------------------

from basketry.streaming import queries as stream  # noqa: E402


@query("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    return stream.stream_quarantine(spark, fixtures.corrupt_some(_feed(spark, _v(spark, sf_dir))))


@query("stream_scan_enrich")
def q_stream_scan_enrich(spark, sf_dir):
    v = _v(spark, sf_dir)
    return stream.stream_scan_enrich(spark, _feed(spark, v), v.catalog)


@query("stream_help_by_aisle")
def q_stream_help_by_aisle(spark, sf_dir):
    return stream.stream_help_by_aisle(spark, _feed(spark, _v(spark, sf_dir)))


@query("stream_help_by_aisle_sliding")
def q_stream_help_by_aisle_sliding(spark, sf_dir):
    return stream.stream_help_by_aisle(spark, _feed(spark, _v(spark, sf_dir)), slide="5 minutes")


@query("stream_paid_completed")
def q_stream_paid_completed(spark, sf_dir):
    return stream.stream_paid_completed(spark, fixtures.unpaired(_feed(spark, _v(spark, sf_dir))))


@query("stream_event_dedup")
def q_stream_event_dedup(spark, sf_dir):
    return stream.stream_event_dedup(spark, fixtures.redeliver(_feed(spark, _v(spark, sf_dir))))


@query("stream_lookup_dedup")
def q_stream_lookup_dedup(spark, sf_dir):
    v = _v(spark, sf_dir)
    t = v.events.select(F.col("event_id").alias("request_id"), F.col("ts").alias("requested_at"))
    return stream.stream_lookup_dedup(spark, v.barcode_requests.join(t, "request_id"))


@query("stream_cart_expiry")
def q_stream_cart_expiry(spark, sf_dir):
    return stream.stream_cart_expiry(spark, _v(spark, sf_dir).cart_events)


def _line_changes(events):
    return cart_history.history(events, with_clears=True).where("not rejected").select(
        "event_id", "event_time", "session_id", "barcode", "kind", F.col("quantity").cast("bigint").alias("quantity"), F.col("line_price").alias("price"))


@query("stream_upsert_sink")
def q_stream_upsert_sink(spark, sf_dir):
    return stream.stream_upsert_sink(spark, _line_changes(_v(spark, sf_dir).cart_events))


@query("stream_cart_state")
def q_stream_cart_state(spark, sf_dir):
    return stream.stream_cart_state(spark, _v(spark, sf_dir).cart_events)


@query("stream_session_state")
def q_stream_session_state(spark, sf_dir):
    return stream.stream_session_state(spark, _v(spark, sf_dir).session_log)


# --- the request path as one plan --------------------------------------------------

from basketry.plans import checkout  # noqa: E402


@query("cart_request_flow")
def q_cart_request_flow(spark, sf_dir):
    v = _v(spark, sf_dir)
    cmds = checkout.cart_commands(v.cart_events, v.sessions, v.access_log)
    return checkout.cart_request_flow(cmds, v.sessions, v.catalog)
