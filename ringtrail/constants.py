"""Fixed values that results depend on.

Everything here is data, not logic: ids, labels, texts, thresholds and lookup
tables that have to be exactly these for results to be comparable.
"""

# --- fixed values: typologies -------------------------------------------------
CIRCULAR_FLOW = "circular_flow_v1"
MULE_HUB = "mule_hub_v1"
LAUNDERING_EXPOSURE = "laundering_exposure_v1"

FINDING_TYPES = {
    CIRCULAR_FLOW: "CIRCULAR_FLOW",
    MULE_HUB: "MULE_HUB",
    LAUNDERING_EXPOSURE: "LAUNDERING_EXPOSURE",
}
ASSESSMENT_ORDER = [CIRCULAR_FLOW, MULE_HUB, LAUNDERING_EXPOSURE]

# --- fixed values: severities -------------------------------------------------
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
RING_HIGH_MAX_RATIO = "1.2"
HUB_CRITICAL_DEGREE = 50
HUB_HIGH_DEGREE = 20
EXPOSURE_CRITICAL_EDGES = 50
EXPOSURE_HIGH_EDGES = 30

# --- fixed values: provenance labels --------------------------------------------
ACCOUNTS_SOURCE = "HI-Small_accounts.csv"
TRANSACTIONS_SOURCE = "HI-Small_Trans.csv"
SYNTHESIZED_SOURCE = "SYNTHESIZED (1:1 party-per-account)"
PRIMARY_OWNER = "PRIMARY_OWNER"

# --- fixed values: graph vocabulary ---------------------------------------------
ACCOUNT = "Account"
PARTY = "Party"
INSTITUTION = "FinancialInstitution"
TRANSFER_EDGE = "transfers_to"
RING_MEMBER = "ring_member"
ACCOUNT_OWNER = "account_owner"
CUSTODIAN_BANK = "custodian_bank"
HUB_ROLE = "mule_hub"
EXPOSED_ROLE = "exposed_account"
INBOUND_COUNTERPARTY = "inbound_counterparty"
OUTBOUND_COUNTERPARTY = "outbound_counterparty"

# --- fixed values: display lookups ----------------------------------------------
CURRENCY_CODES = {
    "Saudi Riyal": "SAR",
    "US Dollar": "USD",
    "Euro": "EUR",
    "UK Pound": "GBP",
    "British Pound": "GBP",
    "Swiss Franc": "CHF",
    "Yen": "JPY",
    "Australian Dollar": "AUD",
    "Canadian Dollar": "CAD",
    "Ruble": "RUB",
    "Yuan": "CNY",
    "Bitcoin": "BTC",
    "Mexican Peso": "MXN",
    "Brazil Real": "BRL",
    "Rupee": "INR",
    "Shekel": "ILS",
}
COUNTRY_NAMES = {
    "AE": "United Arab Emirates",
    "AU": "Australia",
    "BR": "Brazil",
    "CA": "Canada",
    "CH": "Switzerland",
    "CN": "China",
    "DE": "Germany",
    "ES": "Spain",
    "FR": "France",
    "GB": "United Kingdom",
    "HK": "Hong Kong",
    "IN": "India",
    "IT": "Italy",
    "JP": "Japan",
    "MX": "Mexico",
    "NL": "Netherlands",
    "PL": "Poland",
    "RU": "Russia",
    "SA": "Saudi Arabia",
    "SG": "Singapore",
    "US": "United States",
}
MISSING_TEXT = "—"
