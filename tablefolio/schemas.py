"""Canonical schemas."""

PORTFOLIO = (
    "table_id string, row_idx int, company_name string, security_type string, investment_date string, "
    "ownership double, gross_irr double, gross_moic double, total_cost double, shares double, "
    "unrealized_value double, realized_value double, total double, is_total boolean, total_exp double, "
    "is_validated boolean, filled_metrics array<string>"
)
ERRORS = "table_id string, code string, level string, description string"
LINEAGE = "table_id string, target string, src string, rule string"
TABLE_ROWS = "table_id string, row_idx int, values array<string>"
TABLE_HEADERS = "table_id string, header array<string>"
LAYOUT_CELLS = (
    "table_id string, cell_ord int, page int, row_index int, column_index int, column_span int, content string, "
    "row_count int, column_count int"
)
SPANS = (
    "doc_id string, page int, span_ord int, text string, size double, dir_x double, block_y0 double, "
    "page_height double, x0 double, y0 double, x1 double, y1 double"
)
PAGE_REGISTRY = (
    "report_path string, report_name string, page_count int, page_ori int, page_new bigint, table_type string, "
    "is_processed boolean"
)
