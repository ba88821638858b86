"""A small catalog for tests."""

from lodeframe.facets import load_catalog

TEXT = """
registry_version: "1.0"
search:
  query_fields: [title]
  sort_fields:
    - {field: price, index_field: price, orders: [asc, desc]}
    - {field: newest, index_field: published_at, orders: [desc]}
fields:
  - name: flavor
    type: categorical
    index_field: flavor
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    values:
      - {code: pistachio, label: Pistachio, aliases: [green nut]}
      - {code: peanut, label: Peanut, aliases: []}
      - {code: matcha, label: Matcha, aliases: [green tea]}
  - name: allergen
    type: categorical
    index_field: allergen
    hard_operators: [in, not_in]
    soft_operators: [prefer, avoid]
    unknown_passes: false
    values:
      - {code: tree_nut, label: Tree nut, aliases: []}
      - {code: almond, label: Almond, aliases: [], parent: tree_nut}
      - {code: cashew, label: Cashew, aliases: [], parent: tree_nut}
      - {code: milk, label: Milk, aliases: []}
  - name: stable
    type: boolean
    index_field: stable
    hard_operators: [eq]
    soft_operators: []
  - name: level
    type: integer
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    minimum: 1
    maximum: 5
  - name: price
    type: number
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    minimum: 0
    unit_kind: currency
    unit_pattern: "^[A-Z]{3}$"
  - name: size
    type: number
    index_field: size_g
    hard_operators: [eq, gte, lte, between]
    soft_operators: [lower, higher, around]
    minimum: 0
    exclusive_minimum: true
    unit_kind: mass
    base_unit: g
    units:
      - {code: g, factor: 1}
      - {code: kg, factor: 1000}
      - {code: oz, factor: 28.349523125}
"""
CATALOG = load_catalog(TEXT)


def condition(field, op, soft=False, **parts):
    key = "preference" if soft else "op"
    return {"field": field, key: op, "value": None, "values": [], "min_value": None, "max_value": None, "unit": None} | parts


def patch(**parts):
    empty = {"schema_version": "1.0", "reset": False, "query_text": None, "hard_filters": [], "soft_preferences": [], "sort": None, "clear_fields": [], "unmapped_terms": []}
    return empty | parts
