"""Fixed values that results depend on.

FIXED VALUES: these must stay equal to the values the analysed benchmark
suite uses; changing them changes results.
"""

# FIXED VALUES -------------------------------------------------------------

# Benchmark systems, in the order the suite lists them.
DEFAULT_SYSTEMS = ("bace", "p38", "jnk1", "cdk2", "ptp1b", "tyk2", "mcl1", "thrombin")

# Phases of a relative binding free energy run.
RBFE_PHASES = ("complex", "solvent")

# Manifest layout version accepted by the exports.
MANIFEST_SCHEMA_VERSION = 4

# Hours per day used to turn an hourly price into a daily one.
HOURS_PER_DAY = 24.0

# Simulated nanoseconds per RBFE edge.
RBFE_NS_PER_EDGE = 66

# Concurrency levels (processes per GPU) compared in the scaling views.
CONCURRENCY_LEVELS = (1, 2, 4)

# Display order of instance types in the chart tables.
INSTANCE_ORDER = ("g4dn.xlarge", "g5.xlarge", "g6e.xlarge")

# Benchmark type labels and the metric name written into the fact.
MD = "md"
RBFE = "rbfe"
METRIC_NAME = "ns_per_day"

# Price-list location names by region code.
REGION_NAMES = {
    "us-east-1": "US East (N. Virginia)",
    "us-east-2": "US East (Ohio)",
    "us-west-1": "US West (N. California)",
    "us-west-2": "US West (Oregon)",
}

# Price-list service of the instances.
SERVICE_CODE = "AmazonEC2"

# Product attribute filters for a shared-tenancy Linux on-demand price.
PRODUCT_FILTERS = {
    "operatingSystem": "Linux",
    "preInstalledSw": "NA",
    "capacitystatus": "Used",
    "tenancy": "Shared",
}

# Unit and currency of the price dimension that is kept.
PRICE_UNIT = "Hrs"
PRICE_CURRENCY = "USD"

# Run tree file names.
MD_OUTPUT_FILE = "md_benchmark.out"
RBFE_OUTPUT_FILE = "rbfe_benchmark.out"
MANIFEST_FILE = "manifest.json"

# END FIXED VALUES ---------------------------------------------------------
