"""DuckDB statements that every registered query of the shop's jobs is compared with.

Written from the operator definitions of SURVEY section 2: counts and totals are aggregated first and joined, exclusions
are anti joins, first and last rows of a pinned order are the head of an ordered list. A ``Scope`` holds what differs
between the staged job (per customer) and the backfill (per customer and consultant).
"""

from __future__ import annotations

from dataclasses import dataclass

from ordercraft.checks.fixture_sql import with_binding

AS_OF = "TIMESTAMP '2001-08-01 12:00:00'"
START = "TIMESTAMP '2001-01-01 00:00:00'"
IMAGE_PREFIX = "//images.example/sku/"


def year_before(moment: str) -> str:
    """Twelve months earlier: month end stays month end, the time of day stays."""
    day = f"{moment}::DATE"
    moved = f"({day} - INTERVAL 12 MONTH)::DATE"
    return f"(if({day} = last_day({day}), last_day({moved}), {moved})::TIMESTAMP + ({moment} - ({day})::TIMESTAMP))"


RECENT = f"submitted_date > {year_before(AS_OF)}"

BASICS = f"""
line AS (
  SELECT order_id, catalog_ref_id AS sku, product_id, quantity
  FROM dcspp_item JOIN dcspp_order_item ON commerce_items = commerce_item_id
),
payment AS (
  SELECT order_ref AS order_id, count(*) AS groups, count(*) FILTER (state = 'SETTLED') > 0 AS settled
  FROM dcspp_pay_group GROUP BY order_ref
),
consultant AS (SELECT order_id, count(*) AS consultants, max(cn_id) AS cn_id FROM nt_order GROUP BY order_id),
sku_name AS (SELECT sku_code AS sku, display_name FROM nt_sku JOIN dcs_sku USING (sku_id)),
mapped_product AS (SELECT product_id, display_name FROM dcs_product SEMI JOIN nt_product USING (product_id)),
active_order AS (
  SELECT order_id, state, submitted_date, profile_id
  FROM dcspp_order SEMI JOIN (FROM payment WHERE settled) USING (order_id)
  WHERE state IN ('SUBMITTED', 'NO_PENDING_ACTION')
),
staged_order AS (
  SELECT DISTINCT * FROM active_order SEMI JOIN dcspp_order_item_stg USING (order_id)
  JOIN payment USING (order_id) LEFT JOIN consultant USING (order_id)
  WHERE state = 'SUBMITTED'
),
s_driver AS (
  SELECT order_id, state, submitted_date, profile_id, cn_id FROM staged_order
  WHERE groups = 1 AND {RECENT} AND consultants = 1 AND cn_id IS NOT NULL
),
s_set_aside AS (
  SELECT order_id, profile_id AS cf_id, NULL::VARCHAR AS cn_id, 'several payment groups' AS reason, 'O' AS source
  FROM staged_order WHERE groups > 1
  UNION ALL
  SELECT order_id, profile_id, NULL, 'several consultant rows', 'O'
  FROM staged_order WHERE groups = 1 AND {RECENT} AND consultants > 1
),
b_driver AS (
  SELECT DISTINCT order_id, state, submitted_date, profile_id, nt_order.cn_id
  FROM active_order JOIN nt_order USING (order_id) WHERE submitted_date >= {START} AND {RECENT}
),
latest AS (
  SELECT DISTINCT profile_id AS cf_id, cn_id, submitted_date AS order_date
  FROM (FROM dcspp_order QUALIFY submitted_date = max(submitted_date) OVER (PARTITION BY profile_id))
  JOIN nt_order USING (order_id)
)"""


@dataclass(frozen=True)
class Scope:
    """``name``: prefix of the scope's tables; ``key``: what an offer belongs to."""

    name: str
    key: tuple[str, ...]

    @property
    def keys(self) -> str:
        return ", ".join(self.key)

    def columns(self, alias: str) -> str:
        return ", ".join(f"{alias}.{k}" for k in self.key)

    def candidates(self) -> str:
        n = self.name
        return f"""
{n}_order AS (SELECT DISTINCT order_id, submitted_date, profile_id FROM {n}_driver),
{n}_line AS (SELECT line.* FROM line SEMI JOIN {n}_order USING (order_id)),
{n}_per_sku AS (SELECT order_id, sku, count(*) AS lines, max(quantity) AS most FROM {n}_line GROUP BY ALL),
{n}_rebuy AS (
  SELECT DISTINCT l.order_id, buy.sku_order, buy.sku_rebuy, CASE lines WHEN 1 THEN most * again.expiration END AS extra, lines
  FROM {n}_line l
  JOIN cit_product_refil buy ON buy.sku_order = l.sku AND buy.sku_rebuy <> l.sku
  JOIN cit_product_refil again ON again.sku_order = buy.sku_rebuy
  LEFT JOIN {n}_per_sku c ON c.order_id = l.order_id AND c.sku = buy.sku_rebuy
),
{n}_own_rule AS (
  SELECT DISTINCT order_id, sku AS sku_order, sku_rebuy FROM {n}_line JOIN cit_product_refil ON sku_order = sku AND sku_rebuy = sku
),
{n}_repeated AS (SELECT DISTINCT order_id FROM {n}_rebuy WHERE lines > 1),
{n}_temp AS (
  SELECT DISTINCT 'R' AS code, order_id, sku_order, extra AS expiration, sku_rebuy FROM {n}_rebuy
  UNION ALL SELECT 'F', order_id, sku_order, 0, sku_rebuy FROM {n}_own_rule
),
{n}_named AS (
  SELECT order_id, sku_order, sku_rebuy, coalesce(extra, 0) AS extra FROM {n}_rebuy
  UNION ALL SELECT order_id, sku_order, sku_rebuy, 0 FROM {n}_own_rule ANTI JOIN {n}_rebuy USING (order_id, sku_rebuy)
),
{n}_ruled AS (
  SELECT o.order_id, rule.sku_rebuy AS sku, display_name AS description, rule.refillable, profile_id AS cf_id, nt_order.cn_id,
         (submitted_date + to_days(rule.expiration + extra))::DATE::TIMESTAMP AS expiration,
         rule.sku_rebuy = t.sku_rebuy AS paired
  FROM {n}_named t
  JOIN cit_product_refil rule ON rule.sku_order = t.sku_order AND rule.sku_rebuy IS NOT NULL
  JOIN sku_name ON sku_name.sku = t.sku_rebuy
  JOIN {n}_order o ON o.order_id = t.order_id
  JOIN nt_order ON nt_order.order_id = t.order_id
  WHERE submitted_date + to_days(rule.expiration + extra + 60) >= {AS_OF}
),
{n}_default AS (
  SELECT l.order_id, l.sku, display_name AS description, 'N' AS refillable, profile_id AS cf_id, nt_order.cn_id,
         submitted_date + to_days(90) AS expiration
  FROM (FROM {n}_line x ANTI JOIN cit_product_refil r ON r.sku_order = x.sku) l
  JOIN mapped_product USING (product_id)
  JOIN {n}_order o ON o.order_id = l.order_id
  JOIN nt_order ON nt_order.order_id = l.order_id
  WHERE submitted_date + to_days(150) >= {AS_OF}
),
{n}_candidate AS (
  SELECT DISTINCT * FROM (SELECT * EXCLUDE (paired) FROM {n}_ruled UNION ALL FROM {n}_default) ANTI JOIN {n}_repeated USING (order_id)
),
{n}_paired AS (
  SELECT DISTINCT * FROM (SELECT * EXCLUDE (paired) FROM {n}_ruled WHERE paired UNION ALL FROM {n}_default)
  ANTI JOIN {n}_repeated USING (order_id)
)"""

    def refills(self, out: str, stored: str, per_row: bool = False) -> str:
        """Next refill table ``{out}`` and would-be inserts ``{out}_insert``, from the candidates and ``stored``."""
        n = self.name
        row = "{sku: sku, description: description, refillable: refillable, cf_id: cf_id, cn_id: cn_id, expiration: expiration}"
        rising = ", ".join(f"{c} ASC NULLS LAST" for c in ("sku", "description", "refillable", "cf_id", "cn_id", "expiration"))
        falling = ", ".join(f"{c} DESC NULLS FIRST" for c in ("description", "refillable", "expiration"))
        if per_row:
            known = f"""
{out}_known AS (
  SELECT c.*, r.n IS NOT NULL AS known FROM {n}_candidate c
  LEFT JOIN (SELECT cn_id, cf_id, sku, order_id, count(*) AS n FROM {stored} GROUP BY ALL) r USING (cn_id, cf_id, sku, order_id)
)"""
        else:
            known = f"""
{out}_head AS (SELECT order_id, list({row} ORDER BY {rising})[1] AS head FROM {n}_candidate GROUP BY order_id),
{out}_met AS (
  SELECT h.order_id, count(r.order_id) AS met FROM {out}_head h
  LEFT JOIN {stored} r ON r.order_id = h.order_id AND r.sku = head.sku AND r.cf_id = head.cf_id AND r.cn_id = head.cn_id
  GROUP BY h.order_id
),
{out}_known AS (SELECT c.*, met = 1 AS known FROM {n}_candidate c JOIN {out}_met USING (order_id))"""
        return f"""{known},
{out}_group AS (
  SELECT order_id, (SELECT coalesce(max(id_key), 0) FROM cit_refil) + row_number() OVER (ORDER BY submitted_date, order_id) AS id_key
  FROM {n}_order SEMI JOIN (FROM {out}_known WHERE NOT known) USING (order_id)
),
{out}_change AS (
  SELECT cn_id, cf_id, sku, order_id, list({{refillable: refillable, expiration: expiration}} ORDER BY {falling})[1] AS last
  FROM {out}_known WHERE known GROUP BY ALL
),
{out}_insert AS (SELECT k.*, id_key FROM {out}_known k JOIN {out}_group USING (order_id) WHERE NOT known),
{out} AS (
  SELECT id_key, description, sku, if(last IS NULL, refillable, last.refillable) AS refillable,
         if(last IS NULL, expiration, last.expiration) AS expiration, cf_id, cn_id, order_id
  FROM {stored} LEFT JOIN {out}_change USING (cn_id, cf_id, sku, order_id)
  UNION ALL
  SELECT id_key, description, sku, refillable, expiration, cf_id, cn_id, order_id FROM {out}_insert WHERE sku IS NOT NULL
)"""

    def offers(self) -> str:
        n, keys = self.name, self.keys
        with_consultant = "cn_id" in self.key
        who = "JOIN nt_order USING (order_id)" if with_consultant else ""
        context = "(profile_id, cn_id)" if with_consultant else "profile_id"
        columns = "profile_id AS cf_id" + (", nt_order.cn_id" if with_consultant else "")
        join_cn = "nt_order.cn_id" if with_consultant else ""
        wanted = f"({'profile_id, ' + join_cn if with_consultant else 'profile_id'})"
        context += " FROM b_driver WHERE cn_id IS NOT NULL" if with_consultant else " FROM s_driver"
        chosen = "DISTINCT latest.cn_id" if with_consultant else "latest.cn_id"
        return f"""
{n}_brand AS (
  SELECT DISTINCT {columns}, brand_id
  FROM active_order {who} JOIN line USING (order_id) JOIN oe_product USING (product_id) SEMI JOIN oe_brand USING (brand_id)
  WHERE {RECENT} AND {wanted} IN (SELECT {context})
),
{n}_open AS (
  SELECT {self.columns('has')}, brand_order, brand_offer, interest, support
  FROM {n}_brand has JOIN cit_offer ON brand_order = has.brand_id
  ANTI JOIN {n}_brand other ON {' AND '.join(f'other.{k} = has.{k}' for k in self.key)} AND other.brand_id = brand_offer
  WHERE brand_offer IS NOT NULL
),
{n}_best AS (
  FROM (FROM {n}_open QUALIFY interest = max(interest) OVER (PARTITION BY {keys}))
  QUALIFY support = max(support) OVER (PARTITION BY {keys})
),
{n}_offer AS (
  SELECT {chosen}, latest.cf_id, oe_brand.name AS offer, order_date
  FROM {n}_best best JOIN oe_brand ON oe_brand.brand_id = brand_offer
  JOIN latest ON {' AND '.join(f'latest.{k} = best.{k}' for k in self.key)}
)"""

    def opportunities(self, out: str, stored: str, view: str) -> str:
        """Next opportunity table ``{out}``, blocked keys ``{out}_blocked``, from the offers, ``stored`` and the pointer view."""
        n, keys = self.name, self.keys
        row = "{cn_id: cn_id, cf_id: cf_id, offer: offer, order_date: order_date}"
        cleared = f"""if(blocked_first IS NOT NULL AND (SELECT max(id_key) FROM {view} v
                     WHERE v.cf_id = blocked_first.cf_id AND v.cn_id = blocked_first.cn_id) IS NOT NULL, NULL, refil)""" \
            if n == "s" else "refil"
        return f"""
{out}_key AS (
  SELECT {keys}, list({row} ORDER BY cn_id DESC NULLS FIRST, offer DESC NULLS FIRST)[1] AS last,
         list({row} ORDER BY cn_id ASC NULLS LAST, offer ASC NULLS LAST)[1] AS first
  FROM {n}_offer WHERE cn_id IS NOT NULL GROUP BY ALL
),
{out}_stored AS (SELECT {keys}, count(*) AS stored FROM {stored} GROUP BY ALL),
{out}_decided AS (SELECT k.*, coalesce(stored, 0) > 1 AS blocked FROM {out}_key k LEFT JOIN {out}_stored USING ({keys})),
{out}_blocked AS (SELECT {keys}, first AS blocked_first, last FROM {out}_decided WHERE blocked),
{out}_replaced AS (SELECT {keys}, last FROM {out}_decided WHERE NOT blocked),
{out} AS (
  SELECT cn_id, cf_id, offer, {cleared} AS refil, order_date
  FROM (FROM {stored} ANTI JOIN {out}_replaced USING ({keys})) LEFT JOIN (SELECT {keys}, blocked_first FROM {out}_blocked) USING ({keys})
  UNION ALL
  SELECT last.cn_id, last.cf_id, last.offer, refil, last.order_date
  FROM {out}_replaced r
  LEFT JOIN (SELECT cf_id AS pf, cn_id AS pc, max(id_key) AS refil FROM {view} GROUP BY ALL) ON pf = last.cf_id AND pc = last.cn_id
  WHERE last.cf_id IS NOT NULL AND last.offer IS NOT NULL
)"""

    def set_aside(self, out: str) -> str:
        """Quarantined rows of a run whose opportunities are ``out``."""
        n = self.name
        orders = "FROM s_set_aside UNION ALL" if n == "s" else ""
        cn = "cn_id" if "cn_id" in self.key else "last.cn_id"
        return f"""{orders}
SELECT order_id, profile_id AS cf_id, NULL::VARCHAR AS cn_id, 'refill sku on several lines of the order' AS reason, 'R' AS source
FROM {n}_repeated JOIN {n}_order USING (order_id)
UNION ALL SELECT NULL, cf_id, {cn}, 'several stored opportunities', 'A' FROM {out}_blocked
UNION ALL SELECT DISTINCT NULL, cf_id, cn_id, 'offer without consultant', 'A' FROM {n}_offer WHERE cn_id IS NULL"""

    def walk(self, refills: str) -> str:
        """Inserts of ``refills`` one by one under two unique constraints: ``{refills}_said`` has each one's violated constraint.

        A step of the recursion inserts the next row in the pinned order and carries the keys that are taken by then.
        """
        place = ", ".join(f"{c} ASC NULLS LAST" for c in ("id_key", "sku", "description", "refillable", "cf_id", "cn_id", "expiration"))
        key = lambda i, *c: f"concat_ws('|', {i}, {', '.join(f"coalesce('=' || {x}, '')" for x in c)})"
        one, two = key(1, "cf_id", "sku"), key(2, "sku", "cn_id", "refillable")
        return f"""
{refills}_row AS (
  SELECT *, {one} AS one, {two} AS two, row_number() OVER (ORDER BY {place}) AS pos FROM {refills}_insert WHERE sku IS NOT NULL
),
{refills}_before AS (SELECT {one} AS one, {two} AS two FROM {refills} WHERE id_key NOT IN (SELECT id_key FROM {refills}_insert)),
{refills}_open AS (
  SELECT pos, one, two, one IN (SELECT one FROM {refills}_before) AS had_one, two IN (SELECT two FROM {refills}_before) AS had_two
  FROM {refills}_row
),
{refills}_walk AS (
  SELECT 0::BIGINT AS pos, []::VARCHAR[] AS taken, 0 AS said
  UNION ALL
  SELECT r.pos, if(v.said = 0, w.taken || [r.one, r.two], w.taken), v.said
  FROM {refills}_walk w JOIN {refills}_open r ON r.pos = w.pos + 1,
  LATERAL (SELECT CASE WHEN r.had_one OR list_contains(w.taken, r.one) THEN 1 WHEN r.had_two OR list_contains(w.taken, r.two) THEN 2 ELSE 0 END AS said) v
),
{refills}_said AS (SELECT r.*, said FROM {refills}_row r JOIN {refills}_walk w ON w.pos = r.pos)"""

    def errors(self, refills: str, opportunities: str, more: str = "") -> str:
        """Numbered error rows: refill inserts without SKU, and offers without name for every order they were tried for.

        ``more``: a query of further (order_id, error, source, error_code).
        """
        n, keys = self.name, self.keys
        context = "profile_id AS cf_id, order_id" + (", cn_id" if "cn_id" in self.key else "")
        return f"""
SELECT row_number() OVER (ORDER BY source DESC, order_id, error)::BIGINT AS id, order_id, error, {AS_OF} AS error_date,
       error_code, source
FROM (
  SELECT order_id, 'cannot insert NULL into cit_refil.sku' AS error, 'R' AS source, -1400 AS error_code FROM {refills}_insert WHERE sku IS NULL
  {more}
  UNION ALL
  SELECT c.order_id, 'cannot insert NULL into cit_opportunities.offer', 'A', -1400
  FROM (SELECT DISTINCT {context} FROM {n}_driver) c
  JOIN (FROM {n}_offer SEMI JOIN {opportunities}_replaced USING ({keys})) o USING ({keys})
  WHERE o.offer IS NULL AND o.cn_id IS NOT NULL
)"""


STAGED = Scope("s", ("cf_id",))
BACKFILL = Scope("b", ("cf_id", "cn_id"))

REST = f"""
any_backfill AS (SELECT count(*) > 0 AS found FROM b_driver),
b_stored_refill AS (
  SELECT cit_refil.* FROM cit_refil LEFT JOIN (SELECT DISTINCT order_id, true AS started FROM dcspp_order WHERE submitted_date >= {START})
  USING (order_id) WHERE started IS NULL OR NOT (SELECT found FROM any_backfill)
),
b_stored_offer AS (
  FROM cit_opportunities WHERE order_date IS NULL OR order_date < {START} OR NOT (SELECT found FROM any_backfill)
),
given_view AS (SELECT cf_id, cn_id, id_key FROM cit_refil WHERE expiration >= {START})"""

PURGED = f"""
s_kept AS (
  FROM s_refill WHERE expiration IS NULL OR expiration + to_days(60) >= {AS_OF} OR (SELECT count(*) FROM s_driver) = 0
)"""

REFILL = "id_key, description, sku, refillable, expiration, cf_id, cn_id, order_id"
OPPORTUNITY = "cn_id, cf_id, offer, refil, order_date"


MOVED = """(
  SELECT if(substring(order_id, 2)::BIGINT % 2 = 0, (SELECT 'O' || max(o_orderkey) FROM orders WHERE o_orderkey % 59 <> 0), order_id) AS order_id,
         commerce_items
  FROM dcspp_order_item
)"""


def _details(product: str, links: str = "dcspp_order_item") -> str:
    return with_binding(f"""
mapped AS (SELECT product_id, display_name FROM dcs_product SEMI JOIN nt_product USING (product_id)),
adjusted AS (
  SELECT amount_info_id, adjustment, pricing_model FROM dcspp_amtinfo_adj LEFT JOIN dcspp_price_adjust ON adjustment_id = adjustments
),
order_cut AS (
  SELECT amount_info_id, sum(adjustment)::DECIMAL(19,2) AS order_discount
  FROM adjusted JOIN dcspp_order_price USING (amount_info_id)
  WHERE adjustment < 0 AND adjustment <> raw_subtotal GROUP BY amount_info_id
),
item AS (
  SELECT order_id, catalog_ref_id, item.product_id, {product}.display_name, quantity, list_price, raw_total_price, order_discount,
         if(price.amount_info_id IS NULL, NULL, adjustment) AS adjustment,
         if(price.amount_info_id IS NULL, NULL, pricing_model) AS pricing_model
  FROM {links} JOIN dcspp_item item ON commerce_items = commerce_item_id
  JOIN {product} USING (product_id)
  LEFT JOIN dcspp_item_price price ON price.amount_info_id = item.price_info
  LEFT JOIN adjusted ON adjusted.amount_info_id = item.price_info
),
paid AS (
  SELECT order_ref AS order_id, state AS pay_state, payment_method, installments FROM dcspp_pay_group
  LEFT JOIN (SELECT payment_group_id, min(no_of_payments) AS installments FROM oe_pay_group GROUP BY ALL) USING (payment_group_id)
),
sent AS (
  SELECT order_ref AS order_id, sched_deliv_date FROM dcspp_ship_group LEFT JOIN nt_ship_group USING (shipping_group_id)
)""", f"""
SELECT DISTINCT profile_id AS cf_id, cn_id, o.order_id AS order_number, order_number AS order_number_broker, o.state AS order_state,
  pay_state AS state, submitted_date AS order_date, catalog_ref_id AS sku_id, product_id, display_name, quantity,
  if(adjustment = quantity * list_price, 0, adjustment)::DECIMAL(19,2) AS un_discount, list_price AS un_price, raw_subtotal,
  raw_total_price, pricing_model AS promotion_id, coupon_id, shipping, raw_subtotal AS order_total,
  item.order_discount AS item_discount, concat(first_name, ' ', last_name) AS customer_name, email AS customer_email,
  date_of_birth AS customer_birthday, creation_date, last_modified_date, sched_deliv_date AS deliver_date, payment_method,
  'MOCK - MK' AS city_state, concat('{IMAGE_PREFIX}', catalog_ref_id, '_1.jpg') AS image_url, installments,
  order_cut.order_discount
FROM dcspp_order o
JOIN dps_user ON id = profile_id
JOIN oe_order USING (order_id)
JOIN nt_order USING (order_id)
JOIN item USING (order_id)
JOIN paid USING (order_id)
JOIN sent USING (order_id)
LEFT JOIN dcspp_order_price op ON op.amount_info_id = o.price_info
LEFT JOIN order_cut ON order_cut.amount_info_id = o.price_info""")


def oracle_queries() -> dict[str, str]:
    staged = [BASICS, STAGED.candidates()]
    backfill = [BASICS, BACKFILL.candidates(), REST]
    staged_run = [*staged, REST, STAGED.refills("s_refill", "cit_refil"), PURGED, STAGED.offers()]
    backfill_run = [*backfill, BACKFILL.refills("b_refill", "b_stored_refill"), BACKFILL.offers()]

    def q(parts: list[str], select: str) -> str:
        return with_binding(",".join(parts), select)

    out = {
        "order_details": _details("mapped"),
        "order_details_legacy": _details("dcs_product"),
        "installments_first": with_binding(
            "", "SELECT payment_group_id, min(no_of_payments) AS installments FROM oe_pay_group GROUP BY payment_group_id"),
        "order_discount_sum": with_binding("", """
SELECT amount_info_id, sum(adjustment)::DECIMAL(19,2) AS order_discount
FROM dcspp_order_price JOIN dcspp_amtinfo_adj USING (amount_info_id) JOIN dcspp_price_adjust ON adjustment_id = adjustments
WHERE adjustment < 0 AND raw_subtotal <> adjustment GROUP BY amount_info_id"""),
        "unit_discount": with_binding("", """
SELECT commerce_item_id, adjustment_id, if(adjustment = quantity * list_price, 0, adjustment)::DECIMAL(19,2) AS un_discount
FROM dcspp_item JOIN dcspp_item_price price ON price.amount_info_id = price_info
JOIN dcspp_amtinfo_adj link ON link.amount_info_id = price_info JOIN dcspp_price_adjust ON adjustment_id = adjustments"""),
        "customer_name_concat": with_binding("", "SELECT id, concat(first_name, ' ', last_name) AS customer_name FROM dps_user"),
        "months_cutoff": with_binding(
            "", f"SELECT order_id, submitted_date, {year_before('submitted_date')} AS cutoff FROM dcspp_order"),
        "expiry_arithmetic": q([BASICS], f"""
SELECT DISTINCT order_id, sku_order, sku_rebuy, submitted_date + to_days(expiration) AS due,
  (submitted_date + to_days(expiration))::DATE::TIMESTAMP AS due_day, submitted_date + to_days(expiration + 60) >= {AS_OF} AS in_grace
FROM dcspp_order JOIN line USING (order_id) JOIN cit_product_refil ON sku_order = sku"""),
        "staged_orders": q([BASICS], "FROM s_driver"),
        "backfill_orders": q([BASICS], "FROM b_driver"),
        "order_quarantine": q([BASICS], "FROM s_set_aside"),
        "refill_rebuy": q(staged, "FROM s_temp WHERE code = 'R'"),
        "refill_base": q(staged, "FROM s_temp WHERE code = 'F'"),
        "refill_default": q(staged, "FROM s_default"),
        "refill_candidates": q(staged, "FROM s_candidate"),
        "refill_candidates_paired": q(staged, "FROM s_paired"),
        "refill_candidates_cn": q([BASICS, BACKFILL.candidates()], "FROM b_candidate"),
        "refill_quarantine": q(staged, """
SELECT order_id, profile_id AS cf_id, NULL::VARCHAR AS cn_id, 'refill sku on several lines of the order' AS reason, 'R' AS source
FROM s_order SEMI JOIN s_repeated USING (order_id)"""),
        "refill_upsert": q([*staged, STAGED.refills("s_refill", "cit_refil")], f"SELECT {REFILL} FROM s_refill"),
        "refill_upsert_per_row": q([*staged, STAGED.refills("s_each", "cit_refil", True)], f"SELECT {REFILL} FROM s_each"),
        "refill_purge": with_binding(
            "", f"SELECT {REFILL} FROM cit_refil WHERE coalesce(expiration + to_days(60) >= {AS_OF}, true)"),
        "refill_reset": with_binding(
            "", f"FROM cit_refil ANTI JOIN (FROM dcspp_order WHERE submitted_date >= {START}) USING (order_id) SELECT {REFILL}"),
        "brand_affinity": q([*staged, STAGED.offers()], "FROM s_brand"),
        "brand_affinity_cn": q([*backfill, BACKFILL.offers()], "FROM b_brand"),
        "eligible_rules": q([*staged, STAGED.offers()], "FROM s_open"),
        "top_rules": q([*staged, STAGED.offers()], "FROM s_best"),
        "latest_consultant": q([BASICS], "FROM latest"),
        "also_offers": q([*staged, STAGED.offers()], "FROM s_offer"),
        "also_offers_cn": q([*backfill, BACKFILL.offers()], "FROM b_offer"),
        "refill_pointer": with_binding("", "SELECT cf_id, cn_id, max(id_key) AS refil FROM cit_refil GROUP BY ALL"),
        "opportunity_upsert": q([*staged, STAGED.offers(), STAGED.opportunities("s_next", "cit_opportunities", "cit_refil")],
                                f"SELECT {OPPORTUNITY} FROM s_next"),
        "opportunity_upsert_cn": q([*backfill, BACKFILL.offers(), BACKFILL.opportunities("b_next", "b_stored_offer", "cit_refil")],
                                   f"SELECT {OPPORTUNITY} FROM b_next"),
        "opportunity_reset": with_binding(
            "", f"SELECT {OPPORTUNITY} FROM cit_opportunities WHERE coalesce(order_date < {START}, true)"),
    }
    # Unique checks: the refills without the inserts that a constraint refuses.
    unique_run = [*staged_run[:3], STAGED.refills("s_refill", "cit_refil"), STAGED.walk("s_refill"), f"""
s_kept AS (
  FROM (
    SELECT {REFILL} FROM s_refill WHERE id_key NOT IN (SELECT id_key FROM s_refill_insert)
    UNION ALL SELECT {REFILL} FROM s_refill_said WHERE said = 0
  ) WHERE expiration IS NULL OR expiration + to_days(60) >= {AS_OF} OR (SELECT count(*) FROM s_driver) = 0
)""", STAGED.offers(), STAGED.opportunities("s_next", "cit_opportunities", "s_kept")]
    refused = """UNION ALL
  SELECT order_id, ['unique constraint on cit_refil (cf_id, sku) violated',
                    'unique constraint on cit_refil (sku, cn_id, refillable) violated'][said], 'R', -1 FROM s_refill_said WHERE said > 0"""
    staged_run.append(STAGED.opportunities("s_next", "cit_opportunities", "s_kept"))
    backfill_run.append(BACKFILL.opportunities("b_next", "b_stored_offer", "b_refill"))
    given = [*staged_run[:-1], STAGED.opportunities("s_next", "cit_opportunities", "given_view")]
    moments = ", ".join(f"(TIMESTAMP '2001-0{m}-01 12:00:00')" for m in (6, 7, 8))
    lines = """
raw AS (
  SELECT 'IP' || l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS amount_info_id, l_orderkey AS lk, l_linenumber AS ln,
         (10 + l_partkey % 50) || '.' || lpad((l_orderkey % 40)::VARCHAR, 3, '0') AS price
  FROM lineitem
),
export AS (
  SELECT *, if(lk % 101 = 0, 'ten', price) AS list_price, if(lk % 103 = 0, price || 'e17', ' ' || ln) AS raw_total_price,
         if(ln % 3 <> 0, (ln % 4)::VARCHAR, '') AS order_discount,
         lk % 101 = 0 OR lk % 10 <> 0 AS bad_list, lk % 103 = 0 AS bad_total
  FROM raw
)"""

    def recursive(sql: str) -> str:
        return sql.replace("WITH ", "WITH RECURSIVE ", 1)

    out |= {
        "run_staged_refill_unique": recursive(q(unique_run, f"SELECT {REFILL} FROM s_kept")),
        "error_rows_unique": recursive(q(unique_run, STAGED.errors("s_refill", "s_next", refused))),
        "refill_purge_store": out["refill_purge"],
        "latest_consultant_kept": out["latest_consultant"],
        "brand_affinity_sliding": q([BASICS], f"""
SELECT DISTINCT as_of, profile_id AS cf_id, brand_id
FROM (VALUES {moments}) moment(as_of)
JOIN active_order ON submitted_date <= as_of AND submitted_date > {year_before('as_of')}
JOIN line USING (order_id) JOIN oe_product USING (product_id) SEMI JOIN oe_brand USING (brand_id)
WHERE profile_id IN (SELECT profile_id FROM s_driver)"""),
        "order_details_refreshed": out["order_details"],
        "order_details_hot": _details("mapped", MOVED),
        "order_details_view": f"""
SELECT order_state, payment_method, count(*) AS n, sum(quantity) AS pieces, sum(un_price * quantity) AS worth,
       sum(un_discount) AS discount, count(DISTINCT cf_id) AS customers
FROM ({out["order_details"]}) GROUP BY order_state, payment_method""",
        "ingest_item_prices": f"""WITH {lines.lstrip()}
SELECT amount_info_id, list_price::DECIMAL(19,2) AS list_price, raw_total_price::DECIMAL(19,2) AS raw_total_price,
       nullif(order_discount, '')::DECIMAL(19,2) AS order_discount
FROM export WHERE NOT bad_list AND NOT bad_total""",
        "ingest_rejects": f"""WITH {lines.lstrip()}
SELECT 'dcspp_item_price' AS "table", 'list_price' AS "column", list_price AS value, 'does not fit decimal(19,2)' AS reason
FROM export WHERE bad_list
UNION ALL
SELECT 'dcspp_item_price', 'raw_total_price', raw_total_price, 'does not fit decimal(19,2)' FROM export WHERE bad_total""",
        "ingest_profile": f"""WITH {lines.lstrip()},
part AS (
  SELECT 'amount_info_id' AS "column", 'string' AS type, amount_info_id AS value, false AS bad, false AS number FROM export
  UNION ALL SELECT 'list_price', 'decimal(19,2)', list_price, bad_list, true FROM export
  UNION ALL SELECT 'raw_total_price', 'decimal(19,2)', raw_total_price, bad_total, true FROM export
  UNION ALL SELECT 'order_discount', 'decimal(19,2)', order_discount, false, true FROM export
)
SELECT "column", type, count(*) AS n, count(*) FILTER (value = '') AS nulls, count(*) FILTER (bad) AS lossy,
       max(if(number, len(regexp_extract(trim(value), '\\.(\\d*[1-9])0*$', 1)), NULL)) FILTER (value <> '')::INT AS scale,
       min(if(number, try_cast(trim(value) AS DECIMAL(38,18)), NULL)) AS low,
       max(if(number, try_cast(trim(value) AS DECIMAL(38,18)), NULL)) AS high
FROM part GROUP BY ALL""",
    }
    out |= {
        "run_staged_refill": q(staged_run, f"SELECT {REFILL} FROM s_kept"),
        "run_staged_opportunities": q(staged_run, f"SELECT {OPPORTUNITY} FROM s_next"),
        "run_staged_opportunities_view": q(given, f"SELECT {OPPORTUNITY} FROM s_next"),
        "run_staged_quarantine": q(staged_run, STAGED.set_aside("s_next")),
        "error_rows": q(staged_run, STAGED.errors("s_refill", "s_next")),
        "run_backfill_refill": q(backfill_run, f"SELECT {REFILL} FROM b_refill"),
        "run_backfill_opportunities": q(backfill_run, f"SELECT {OPPORTUNITY} FROM b_next"),
        "run_backfill_quarantine": q(backfill_run, BACKFILL.set_aside("b_next")),
        "error_rows_cn": q(backfill_run, BACKFILL.errors("b_refill", "b_next")),
    }
    return out | {
        "run_staged_opportunities_kept": out["run_staged_opportunities"],
        "run_staged_store_refill": out["run_staged_refill"],
        "run_staged_store_opportunities": out["run_staged_opportunities"],
        "run_staged_store_errors": out["error_rows"],
        "run_staged_store_quarantine": out["run_staged_quarantine"],
        "run_backfill_store_refill": out["run_backfill_refill"],
        "run_backfill_store_opportunities": out["run_backfill_opportunities"],
    }
