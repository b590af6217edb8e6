"""wideloom: customer-360 wide-table operators expressed as Spark DataFrame plans.

Sub-packages:
  functions  column-expression helpers (dates, money, ratios, text)
  sources    table readers, test-table bindings, cell store and sinks
  operators  reusable DataFrame operators (windows, lifecycle, top-N, flags,
             merge, cells codec, typed export, documents, calendar)
  plans      the composite jobs (sections, wide build, export) and the
             column catalog
  streaming  incremental cell upserts driven by Structured Streaming
"""

__version__ = "0.1.0"
