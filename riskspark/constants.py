"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour being
reproduced (feature list and order, labels, rule weights, thresholds, message
texts). They are stated plainly, in their natural order, and are not derived.
Operators receive them as DataFrames or arguments so callers can override them.
"""

# --- FIXED VALUES: log types ------------------------------------------------
SYSTEM_LOG_TYPES = ["INFO", "WARNING", "ERROR", "DEBUG", "AUDIT", "PERF", "SECURITY"]
LLM_LOG_TYPES = ["LLM_REQUEST", "LLM_ERROR", "LLM_TIMEOUT"]

# Columns nulled on the other side after the type split.
LLM_ONLY_COLS = ["llm_model_id", "llm_status", "llm_cost_usd", "llm_response_time_ms"]
SYSTEM_ONLY_COLS = ["service_id", "http_status_code", "client_ip"]

# --- FIXED VALUES: feature matrix (43 columns, in order) --------------------
SYSTEM_FEATURES = [
    "n_sys_requests", "n_unique_ips", "top_ip_share",
    "error_rate", "client_error_rate", "server_error_rate",
    "rate_limit_rate", "timeout_http_rate",
    "pct_error_logtype", "pct_warning_logtype", "pct_security_logtype",
    "pct_audit_logtype", "n_unique_logtypes",
    "security_event_rate", "n_security_events",
    "method_entropy", "pct_post", "pct_delete",
    "avg_score", "min_score", "pct_low_score",
    "n_unique_services", "n_unique_regions", "top_region_share",
    "pct_production", "n_unique_envs",
]
LLM_FEATURES = [
    "n_llm_requests", "llm_error_rate", "llm_timeout_rate",
    "avg_llm_latency", "p95_llm_latency", "max_llm_latency", "pct_slow_llm",
    "avg_llm_cost", "total_llm_cost", "max_llm_cost", "avg_tokens", "max_tokens",
    "n_unique_models", "pct_content_filter", "avg_llm_score",
]
COMBINED_FEATURES = ["llm_to_sys_ratio", "total_requests"]
FEATURE_COLS = SYSTEM_FEATURES + LLM_FEATURES + COMBINED_FEATURES

# --- FIXED VALUES: feature labels (feature -> Spanish label) ----------------
FEATURE_LABELS = {
    "n_sys_requests": "Volumen de requests sistema",
    "n_unique_ips": "IPs únicas",
    "top_ip_share": "Concentración en 1 IP",
    "error_rate": "Tasa de errores HTTP",
    "client_error_rate": "Tasa 4xx (errores cliente)",
    "server_error_rate": "Tasa 5xx (errores servidor)",
    "rate_limit_rate": "Tasa 429 (rate-limit / posible DDoS)",
    "timeout_http_rate": "Tasa 408 (timeouts HTTP)",
    "pct_error_logtype": "% logs tipo ERROR",
    "pct_warning_logtype": "% logs tipo WARNING",
    "pct_security_logtype": "% logs tipo SECURITY",
    "security_event_rate": "Tasa de eventos de seguridad",
    "n_security_events": "Nº eventos de seguridad",
    "pct_post": "% métodos POST",
    "pct_delete": "% métodos DELETE",
    "min_score": "Score mínimo de riesgo (bajo = inusual)",
    "pct_low_score": "% logs con score de riesgo bajo (<0.3)",
    "n_llm_requests": "Volumen de requests LLM",
    "llm_error_rate": "Tasa de errores LLM",
    "llm_timeout_rate": "Tasa de timeouts LLM",
    "avg_llm_latency": "Latencia promedio LLM (ms)",
    "p95_llm_latency": "Latencia p95 LLM (ms)",
    "pct_slow_llm": "% requests LLM lentos (>20 s)",
    "total_llm_cost": "Costo total LLM (USD) en ventana",
    "max_llm_cost": "Costo máximo LLM en ventana (USD)",
    "pct_content_filter": "% prompts con content_filter (sospechosos)",
    "llm_to_sys_ratio": "Ratio LLM vs requests sistema",
    "total_requests": "Volumen total combinado",
}

# --- FIXED VALUES: threat category rules (category, {feature: weight}) -----
ATTACK_RULES = [
    ("DDoS / Flooding de Trafico", {"rate_limit_rate": 4, "n_sys_requests": 2,
                                    "top_ip_share": 1, "total_requests": 1}),
    ("Fuerza Bruta", {"client_error_rate": 3, "n_unique_ips": 2,
                      "security_event_rate": 2, "pct_security_logtype": 1}),
    ("Inyeccion de Prompt LLM", {"pct_content_filter": 5, "llm_error_rate": 2,
                                 "n_llm_requests": 1}),
    ("Sobrecarga de Servidor (5xx)", {"server_error_rate": 4, "timeout_http_rate": 2,
                                      "pct_error_logtype": 1}),
    ("Concentracion Geografica", {"top_region_share": 4, "n_unique_regions": -2,
                                  "top_ip_share": 1}),
    ("Reconocimiento / Escaneo", {"method_entropy": 3, "pct_delete": 3,
                                  "n_unique_ips": 2, "n_unique_services": 1}),
    ("Escalada de Eventos de Seguridad", {"security_event_rate": 4, "n_security_events": 3,
                                          "pct_security_logtype": 2}),
    ("Degradacion de Servicio LLM", {"llm_timeout_rate": 3, "pct_slow_llm": 3,
                                     "avg_llm_latency": 2, "p95_llm_latency": 1}),
    ("Costo LLM Anomalo", {"total_llm_cost": 4, "max_llm_cost": 3,
                           "avg_llm_cost": 2, "avg_tokens": 1}),
]
ATTACK_MIN_SCORE = 1.0
DEFAULT_CATEGORY = "Patron Estadistico Inusual"

# --- FIXED VALUES: English translations for alert messages ------------------
CATEGORY_EN = {
    "DDoS / Flooding de Trafico": "DDoS / Traffic Flooding",
    "Fuerza Bruta": "Brute Force",
    "Inyeccion de Prompt LLM": "LLM Prompt Injection",
    "Sobrecarga de Servidor (5xx)": "Server Overload (5xx)",
    "Concentracion Geografica": "Geographic Concentration",
    "Reconocimiento / Escaneo": "Reconnaissance / Scanning",
    "Escalada de Eventos de Seguridad": "Security Event Escalation",
    "Degradacion de Servicio LLM": "LLM Service Degradation",
    "Costo LLM Anomalo": "Anomalous LLM Cost",
    "Patron Estadistico Inusual": "Unusual Statistical Pattern",
}
LABEL_EN = {
    "Volumen de requests sistema": "System request volume",
    "IPs únicas": "Unique IPs",
    "Concentración en 1 IP": "Top-IP concentration",
    "Tasa de errores HTTP": "HTTP error rate",
    "Tasa 4xx (errores cliente)": "4xx rate (client errors)",
    "Tasa 5xx (errores servidor)": "5xx rate (server errors)",
    "Tasa 429 (rate-limit / posible DDoS)": "429 rate (rate-limit / DDoS)",
    "Tasa 408 (timeouts HTTP)": "408 rate (HTTP timeouts)",
    "% logs tipo ERROR": "% ERROR log type",
    "% logs tipo WARNING": "% WARNING log type",
    "% logs tipo SECURITY": "% SECURITY log type",
    "Tasa de eventos de seguridad": "Security event rate",
    "Nº eventos de seguridad": "# Security events",
    "% métodos POST": "% POST methods",
    "% métodos DELETE": "% DELETE methods",
    "Score mínimo de riesgo (bajo = inusual)": "Min risk score (low = unusual)",
    "% logs con score de riesgo bajo (<0.3)": "% low-risk score logs (<0.3)",
    "Volumen de requests LLM": "LLM request volume",
    "Tasa de errores LLM": "LLM error rate",
    "Tasa de timeouts LLM": "LLM timeout rate",
    "Latencia promedio LLM (ms)": "Avg LLM latency (ms)",
    "Latencia p95 LLM (ms)": "p95 LLM latency (ms)",
    "% requests LLM lentos (>20 s)": "% slow LLM requests (>20s)",
    "Costo total LLM (USD) en ventana": "Total LLM cost (USD) in window",
    "Costo máximo LLM en ventana (USD)": "Max LLM cost in window (USD)",
    "% prompts con content_filter (sospechosos)": "% prompts flagged by content_filter",
    "Ratio LLM vs requests sistema": "LLM-to-system request ratio",
    "Volumen total combinado": "Total combined request volume",
}

# --- FIXED VALUES: detection thresholds and sizes ---------------------------
SPIKE_SIGMA = 2.5
MULTI_BUCKET_N = 3
MULTI_BUCKET_GAP_MINUTES = 10
SEVERITY_HIGH_BELOW = -0.3
SEVERITY_MEDIUM_BELOW = -0.15
TOP_DEVIATIONS = 5
STD_EPSILON = 1e-6
ENTROPY_EPSILON = 1e-10
LOW_SCORE_BELOW = 0.3
SLOW_LLM_MS = 20000
DEFAULT_SCORE = 0.5
BUCKET = "5 minutes"
TRAINING_HOURS = 24
MIN_TRAINING_HOURS = 24
CATCHUP_GAP_HOURS = 0.6
MAX_IDS_PER_BUCKET = 50
MAX_IDS_PER_LOOKUP = 30
KEEP_MODEL_VERSIONS = 3
HEARTBEAT_TIMEOUT_SECONDS = 180
RETRAIN_EVERY = 2

# Isolation forest and half-space trees.
IFOREST_TREES = 150
IFOREST_CONTAMINATION = 0.05
IFOREST_SEED = 42
IFOREST_SAMPLE = 256
HST_TREES = 25
HST_HEIGHT = 8
HST_WINDOW = 8
HST_THRESHOLD = 0.7
STREAMING_FEATURES = [
    "n_sys_requests", "error_rate", "security_event_rate",
    "rate_limit_rate", "server_error_rate", "top_ip_share",
    "n_llm_requests", "llm_error_rate", "llm_timeout_rate",
    "total_llm_cost", "pct_content_filter", "total_requests",
]

# --- FIXED VALUES: alerting --------------------------------------------------
MAX_MESSAGE_CHARS = 300
SECURITY_ALERT_CATEGORIES = ["Escalada de Eventos de Seguridad"]

# --- FIXED VALUES: reason texts (by anomaly type) ---------------------------
REASON_NO_DEVIATION = "Patrón estadístico inusual sin feature dominante."
REASON_SPIKE = ("Pico de tráfico: {n} requests en 5 min (umbral: {threshold}). "
                "Feature más desviada: {label} = {value} (z={z}).")
REASON_MULTI_BUCKET = ("Patrón sostenido en múltiples ventanas. Feature dominante: "
                       "{label} = {value} (z={z}, baseline={baseline}).")
REASON_CATEGORIZATION = ("Combinación inusual de patrones. Top feature: {label} = {value} "
                         "({direction}, z={z}, baseline={baseline}).")
DIRECTION_UP = "(alto)"
DIRECTION_DOWN = "(bajo)"
NO_DEVIATION_DETAIL = "unusual statistical pattern with no dominant feature"

# --- FIXED VALUES: audit report ---------------------------------------------
SEVERITY_MARKS = {"HIGH": "!!!!", "MEDIUM": "!! ", "LOW": "!  "}
SEVERITY_MARK_DEFAULT = "   "
BAR_WIDTH = 20
PIPELINE_ID = "main_pipeline"


def rules_rows():
    """Rule table rows (rule_ord, category, feature, weight), 32 rows."""
    return [(i, name, feat, float(w))
            for i, (name, weights) in enumerate(ATTACK_RULES)
            for feat, w in weights.items()]


def feature_rows():
    """(feature_ord, feature, label, label_en) for the 43 features."""
    out = []
    for i, f in enumerate(FEATURE_COLS):
        label = FEATURE_LABELS.get(f, f)
        out.append((i, f, label, LABEL_EN.get(label, label)))
    return out
