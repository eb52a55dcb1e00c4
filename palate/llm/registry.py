"""The queries of this subpackage and their SQL."""

from palate.llm import (centroid_clusters, chat_format, decontamination, license_scan, mixing, near_dups, neighbour_graphs,
                        quality_rules, ranked_search, substring_dedup, token_counts, token_files, url_filters)

_MODULES = (token_counts, quality_rules, decontamination, url_filters, license_scan, chat_format, token_files,
            substring_dedup, mixing, near_dups, ranked_search, centroid_clusters, neighbour_graphs)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
