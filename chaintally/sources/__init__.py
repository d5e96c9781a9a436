"""Sources and sinks: text lines, typed export tables, registry, results.

Names are resolved on first use, so the rule module can import the line
helpers without importing the typed readers that depend on it.
"""

from importlib import import_module

_WHERE = {
    "parse_export": "export", "scan_blocks": "export",
    "scan_contracts": "export", "scan_transactions": "export",
    "arity": "lines", "field": "lines", "scan_lines": "lines", "split_line": "lines",
    "with_fields": "lines",
    "parse_registry": "registry", "scan_registry": "registry",
    "load_result": "results", "read_pair_keys_raw": "results", "read_pair_result": "results",
    "read_rows": "results", "save_result": "results", "save_rows": "results", "save_top_pairs": "results",
}

__all__ = sorted(_WHERE)


def __getattr__(name):
    if name in _WHERE:
        return getattr(import_module(f"chaintally.sources.{_WHERE[name]}"), name)
    raise AttributeError(name)
