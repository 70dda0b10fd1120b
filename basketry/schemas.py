"""Declared schemas, domain values and the small fixed tables the operators use.

Everything under "FIXED VALUES" must equal the behaviour being reproduced
(state machine edges, role grants, route prefixes, error codes, seed rows).
They are tiny, bounded literal tables; joins against them may broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)

# ---------------------------------------------------------------------------
# FIXED VALUES — domain enums, state machine, grants, routes, error codes.
# ---------------------------------------------------------------------------
SESSION_STATES = ["CREATED", "ACTIVE", "PAYING", "COMPLETED", "CANCELLED"]
TERMINAL_STATES = ["COMPLETED", "CANCELLED"]
QR_STATUSES = ["ACTIVE", "USED", "EXPIRED", "REVOKED"]
QR_TYPES = ["ENTRY", "EXIT"]
REVOCATION_REASONS = ["ROTATED", "LOGOUT", "REUSE_DETECTED", "ADMIN_REVOKE"]

# allowed (from_state, to_state) edges of the session state machine
SESSION_EDGES = [
    ("CREATED", "ACTIVE"), ("CREATED", "CANCELLED"),
    ("ACTIVE", "PAYING"), ("ACTIVE", "CANCELLED"),
    ("PAYING", "COMPLETED"), ("PAYING", "CANCELLED"),
]

# roles and privileges in insertion order (ids start at 1)
ROLES = ["ROLE_CUSTOMER", "ROLE_WORKER", "ROLE_ADMIN"]
PRIVILEGES = [
    "SCAN_PRODUCT", "VIEW_CART", "CHECKOUT",
    "VIEW_HELP_REQUESTS", "CONFIRM_PRICE", "MANAGE_STOCK",
    "MANAGE_USERS", "MANAGE_CATALOG", "VIEW_ANALYTICS",
]
# grant rules: role -> listed privileges; "*" means every privilege
GRANT_RULES = [
    ("ROLE_CUSTOMER", ["SCAN_PRODUCT", "VIEW_CART", "CHECKOUT"]),
    ("ROLE_WORKER", ["VIEW_HELP_REQUESTS", "CONFIRM_PRICE", "MANAGE_STOCK"]),
    ("ROLE_ADMIN", ["*"]),
]
DEFAULT_ROLE = "ROLE_CUSTOMER"

# gateway routes: (route id, path prefix); a prefix matches itself or prefix + "/..."
ROUTES = [
    ("auth-service", "/api/auth"),
    ("product-service", "/api/products"),
    ("cart-service-rest", "/api/cart"),
    ("cart-service-websocket", "/ws"),
    ("session-service-sessions", "/api/sessions"),
    ("session-service-gate", "/api/gate"),
]
OPEN_PATHS = ["/api/auth/", "/actuator/", "/ws/"]

# error kinds the services return: (service, exception, code, http status)
ERROR_CODES = [
    ("auth", "DuplicateResourceException", "duplicate_resource", 409),
    ("auth", "BadCredentialsException", "bad_credentials", 401),
    ("auth", "InvalidTokenException", "invalid_token", 401),
    ("auth", "TokenReuseException", "token_reuse", 401),
    ("auth", "MethodArgumentNotValidException", "validation_failed", 400),
    ("cart", "InvalidSessionException", "invalid_session", 403),
    ("cart", "ProductNotFoundException", "product_not_found", 404),
    ("cart", "CartItemNotFoundException", "cart_item_not_found", 404),
    ("cart", "MethodArgumentNotValidException", "validation_error", 400),
    ("session", "IllegalStateTransitionException", "illegal_transition", 409),
    ("session", "SessionNotFoundException", "session_not_found", 404),
    ("session", "InvalidQrTokenException", "invalid_qr_token", 400),
    ("session", "QrTokenExpiredException", "qr_token_expired", 410),
]

# declared keys and value rules of the twelve tables
UNIQUE_KEYS = {
    "users": {"users.email": ["email"], "users.username": ["username"]},
    "roles": {"roles.name": ["name"]},
    "privileges": {"privileges.name": ["name"]},
    "users_roles": {"users_roles.primary": ["user_id", "role_id"]},
    "roles_privileges": {"roles_privileges.primary": ["role_id", "privilege_id"]},
    "refresh_tokens": {"refresh_tokens.token_hash": ["token_hash"]},
    "categories": {"categories.slug": ["slug"]},
    "products": {"products.barcode": ["barcode"]},
    "cart_items": {"cart_items.session_product": ["session_id", "product_id"]},
    "qr_tokens": {"qr_tokens.correlation_id": ["correlation_id"]},
}
# what names a row; "id" where nothing else is said
ROW_KEYS = {"users_roles": ["user_id", "role_id"], "roles_privileges": ["role_id", "privilege_id"], "cart_items": ["session_id", "product_id"]}
# (child table, column, parent table, its column, are children deleted with the parent)
FOREIGN_KEYS = [
    ("users_roles", "user_id", "users", "id", True), ("users_roles", "role_id", "roles", "id", True),
    ("roles_privileges", "role_id", "roles", "id", True), ("roles_privileges", "privilege_id", "privileges", "id", True),
    ("refresh_tokens", "user_id", "users", "id", True), ("categories", "parent_id", "categories", "id", False),
    ("products", "category_id", "categories", "id", False),
    ("session_state_transitions", "session_id", "shopping_sessions", "id", False),
    ("qr_tokens", "session_id", "shopping_sessions", "id", False),
]
# table -> column -> (required, longest text, allowed values, smallest number)
DOMAINS = {
    "users": {"email": (True, 100, None, None), "username": (True, 50, None, None), "password": (True, 255, None, None),
              "enabled": (True, None, None, None)},
    "roles": {"name": (True, 50, None, None)},
    "privileges": {"name": (True, 100, None, None)},
    "users_roles": {"user_id": (True, None, None, None), "role_id": (True, None, None, None)},
    "refresh_tokens": {"token_hash": (True, 64, None, None), "family_id": (True, None, None, None), "user_id": (True, None, None, None),
                       "revoked": (True, None, None, None),
                       "revocation_reason": (False, 32, REVOCATION_REASONS, None)},
    "categories": {"name": (True, 250, None, None), "slug": (True, 255, None, None)},
    "products": {"barcode": (True, 14, None, None), "name": (True, 255, None, None), "brand": (False, 150, None, None),
                 "price": (True, None, None, 0), "currency_code": (True, 3, None, None), "nutriscore_grade": (False, 1, None, None),
                 "stock_quantity": (True, None, None, None)},
    "cart_items": {"session_id": (True, None, None, None), "product_id": (True, None, None, None), "quantity": (True, None, None, 1),
                   "price_at_addition": (True, None, None, 0)},
    "shopping_sessions": {"user_id": (True, None, None, None), "store_id": (True, None, None, None),
                          "status": (True, 16, SESSION_STATES, None)},
    "session_state_transitions": {"session_id": (True, None, None, None), "from_state": (True, 16, SESSION_STATES, None),
                                  "to_state": (True, 16, SESSION_STATES, None)},
    "qr_tokens": {"correlation_id": (True, 36, None, None), "session_id": (True, None, None, None), "token_type": (True, 10, QR_TYPES, None),
                  "payload": (True, None, None, None), "status": (True, 16, QR_STATUSES, None)},
}

# field defaults applied when a value is absent
DEFAULTS = {
    "store_id": 1, "aisle_number": 0, "currency_code": "EUR", "stock_quantity": 100,
    "rfid_security_required": False, "status": "CREATED", "quantity": 1, "version": 0,
}

# durations
SESSION_TTL = "24 hours"
QR_TTL = "24 hours"
CART_TTL = "24 hours"
REFRESH_TOKEN_TTL = "7 days"
SEARCH_DEFAULT_LIMIT = 10

# seed categories: (id, name, slug, parent_id)
SEED_CATEGORIES = [
    (1, "Produce", "produce", None),
    (2, "Dairy", "dairy", None),
    (3, "Pasta & Sauces", "pasta-sauces", None),
    (4, "Drinks", "drinks", None),
    (5, "Snacks", "snacks", None),
]

# seed products: (barcode, name, brand, price, category_id, aisle, nutriscore, rfid)
# currency EUR and stock 100 for all rows
SEED_PRODUCTS = [
    ("3013921052007", "Bananes", "Cavendish", "1.2900", 1, 1, "a", False),
    ("8410700011244", "Pommes Golden", "Marlene", "2.4900", 1, 1, "a", False),
    ("3560070825639", "Tomates Rondes", "Carrefour", "2.9900", 1, 1, "a", False),
    ("4056489521839", "Avocats", "Nature", "3.9900", 1, 1, "c", False),
    ("3250390003700", "Lait Demi-Ecreme", "Lactel", "1.0500", 2, 2, "a", False),
    ("3033490004750", "Yaourt Nature", "Danone", "2.1500", 2, 2, "a", False),
    ("3175680011480", "Beurre Doux", "President", "2.7900", 2, 2, "d", False),
    ("3073781069563", "Emmental Rape", "President", "3.2900", 2, 2, "d", False),
    ("8076802085738", "Spaghetti N.5", "Barilla", "1.5500", 3, 3, "a", False),
    ("8076809513753", "Penne Rigate", "Barilla", "1.5500", 3, 3, "a", False),
    ("8005110070402", "Passata di Pomodoro", "Mutti", "1.9900", 3, 3, "a", False),
    ("8076809545693", "Pesto alla Genovese", "Barilla", "2.9900", 3, 3, "c", False),
    ("3051580291204", "Jus d'Orange", "Tropicana", "3.4900", 4, 4, "c", False),
    ("5449000000996", "Coca-Cola", "Coca-Cola", "1.9900", 4, 4, "e", False),
    ("3068320114019", "Eau Minerale Naturelle", "Evian", "0.8900", 4, 4, "a", False),
    ("3500610033629", "Vin Rouge Bordeaux", "Baron de Lestac", "5.9900", 4, 4, None, True),
    ("5053990101573", "Pringles Original", "Pringles", "2.4900", 5, 5, "c", False),
    ("7622210449283", "Chocolat au Lait", "Milka", "1.8900", 5, 5, "d", False),
    ("7622210988485", "Petit Beurre", "LU", "1.5900", 5, 5, "a", False),
    ("8410076600608", "Crunchy Granola Bars", "Nature Valley", "3.2900", 5, 5, "c", False),
]
# ---------------------------------------------------------------------------

# column limits from the DDL: column -> max chars
COLUMN_LIMITS = {"barcode": 14, "name": 255, "brand": 150, "currency_code": 3,
                 "nutriscore_grade": 1, "image_url": 512, "email": 100, "username": 50}

CART_EVENT_SCHEMA = T.StructType([
    T.StructField("sessionId", T.StringType()),
    T.StructField("barcode", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("price", T.DecimalType(19, 4)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("aisleNumber", T.IntegerType()),
    T.StructField("userId", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("paidAt", T.StringType()),
    T.StructField("completedAt", T.StringType()),
])


def literal_df(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal table (bounded size; safe to broadcast)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def edges_df(spark: SparkSession) -> DataFrame:
    return literal_df(spark, SESSION_EDGES, "from_state string, to_state string")


def roles_df(spark: SparkSession) -> DataFrame:
    return literal_df(spark, [(i + 1, r) for i, r in enumerate(ROLES)], "role_id long, role_name string")


def privileges_df(spark: SparkSession) -> DataFrame:
    return literal_df(spark, [(i + 1, p) for i, p in enumerate(PRIVILEGES)],
                      "privilege_id long, privilege_name string")


def error_codes_df(spark: SparkSession) -> DataFrame:
    return literal_df(spark, ERROR_CODES, "service string, exception string, code string, http_status int")
