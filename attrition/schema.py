"""Shared column names, the raw input schema and fixed values of the workflow.

One schema object replaces the column lists that the training and the scoring
side would otherwise each keep.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID_COLS = ["RowNumber", "CustomerId", "Surname"]
KEY = "CustomerId"
TARGET = "Exited"

RAW_SCHEMA = T.StructType([
    T.StructField("RowNumber", T.IntegerType()),
    T.StructField("CustomerId", T.LongType()),
    T.StructField("Surname", T.StringType()),
    T.StructField("CreditScore", T.IntegerType()),
    T.StructField("Geography", T.StringType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Tenure", T.IntegerType()),
    T.StructField("Balance", T.DoubleType()),
    T.StructField("NumOfProducts", T.IntegerType()),
    T.StructField("HasCrCard", T.IntegerType()),
    T.StructField("IsActiveMember", T.IntegerType()),
    T.StructField("EstimatedSalary", T.DoubleType()),
    T.StructField("Exited", T.IntegerType()),
])

INPUT_COLS = ["CreditScore", "Geography", "Gender", "Age", "Tenure", "Balance",
              "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary"]

NUM_FEATURES = ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts",
                "EstimatedSalary", "BalanceSalaryRatio", "ProductsPerYear"]
CAT_FEATURES = ["Geography", "Gender", "AgeGroup"]
PASSTHROUGH_FEATURES = ["HasCrCard", "IsActiveMember", "IsActive_by_CreditCard"]

# ---------------------------------------------------------------------------
# These must equal the published workflow's choices.
# ---------------------------------------------------------------------------
SEED_SPLIT = 21          # split, folds, learners
SEED_SAMPLER = 42        # SMOTE / ADASYN / search
TEST_SIZE = 0.10
N_FOLDS = 5
RECALL_FLOOR = 0.60
SCORE_WEIGHTS = {"F1": 0.35, "Recall": 0.40, "ROC-AUC": 0.25}
DEFAULT_THRESHOLD = 0.50
F1_EPSILON = 1e-8
# Age bins, right-closed: (0,35] Young, (35,55] Middle, (55,100] Senior.
AGE_BINS = [(0, 35, "Young"), (35, 55, "Middle"), (55, 100, "Senior")]
# Metric targets for the PASS/FAIL table, in report order.
METRIC_TARGETS = [("ROC-AUC", 0.85), ("F1", 0.55), ("Recall", 0.60), ("Precision", 0.50)]
# Confidence margins |p - t|: < 0.10 Borderline, < 0.25 Moderate, else Strong.
CONFIDENCE_MARGINS = (0.10, 0.25)
# Risk: margin <= 0.15 below the threshold is Elevated.
ELEVATED_MARGIN = 0.15
# Gauge zones in percent: 0-40, 40-60, 60-100.
GAUGE_EDGES = (40.0, 60.0)
TOP_FACTORS = 5
MAX_RECOMMENDATIONS = 3
WATERFALL_SHOWN = 10
GENERAL_ACTION = ("General retention",
                  "Flag for proactive outreach by the retention team within the next billing cycle.")

# Retention action map, in lookup order: feature (or feature prefix) -> (title, text).
FEATURE_ACTIONS = [
    ("IsActiveMember", "Activation outreach",
     "This customer's inactivity is the primary churn driver. "
     "Trigger a personalised call or app re-engagement campaign within 7 days."),
    ("IsActive_by_CreditCard", "Activation outreach",
     "Low engagement combined with credit card inactivity signals disengagement. "
     "A targeted usage incentive (e.g. cashback activation) could re-anchor this customer."),
    ("NumOfProducts", "Product relationship review",
     "Number of products is a key churn signal here. "
     "If the customer holds only one product, prioritise a cross-sell conversation. "
     "If they hold 3+, schedule a service satisfaction check — friction may be the issue."),
    ("ProductsPerYear", "Relationship depth review",
     "Low products-per-year ratio indicates shallow engagement over time. "
     "Review the customer's product history and identify gaps in the relationship."),
    ("Balance", "Balance re-engagement",
     "Account balance is driving this prediction. A zero or declining balance "
     "suggests the customer is moving funds elsewhere. "
     "Consider a high-yield savings offer or a dedicated relationship manager call."),
    ("BalanceSalaryRatio", "Financial health review",
     "The balance-to-salary ratio is unusually low for this customer's income profile. "
     "This may indicate they are banking primarily elsewhere. "
     "A personalised savings or investment product could deepen the relationship."),
    ("CreditScore", "Credit health outreach",
     "Credit score is contributing to churn risk. "
     "If the score is low, proactive credit counselling or a credit-builder product "
     "can improve loyalty. If high, ensure premium products are being offered."),
    ("Tenure", "Loyalty recognition",
     "Tenure is influencing churn. New customers (<2 years) need onboarding reinforcement. "
     "Long-tenured customers at risk deserve a loyalty reward or relationship review call "
     "to acknowledge their history with the bank."),
    ("Age", "Segment-appropriate outreach",
     "Age is a significant driver. Older customers (45+) respond well to dedicated "
     "relationship managers and personalised service. Younger customers respond better "
     "to digital engagement and product flexibility."),
    ("AgeGroup", "Segment-appropriate outreach",
     "Customer age group is influencing this prediction. Review the product and service "
     "offering against what is typical for this segment — mismatched offerings drive churn."),
    ("Geography_Germany", "Regional retention action",
     "German geography is a structural churn signal in this dataset. "
     "Investigate local competitor activity and ensure regional pricing and "
     "product offerings are competitive."),
    ("Geography_Spain", "Regional engagement check",
     "Geography is influencing this prediction. Review regional service quality "
     "and ensure the customer is aware of locally available products."),
    ("Gender_Male", "Personalised engagement",
     "Gender is contributing to the model's prediction in combination with other factors. "
     "Ensure communications and product recommendations are appropriately tailored."),
    ("HasCrCard", "Credit card engagement",
     "Credit card ownership is influencing churn. "
     "If the customer has a card but rarely uses it, a rewards activation campaign may help. "
     "If they don't hold one, a card offer could deepen the relationship."),
    ("EstimatedSalary", "Income-appropriate product review",
     "Salary band is a factor in this prediction. Ensure the customer is on a product "
     "tier appropriate to their income — under-served high-earners churn to premium competitors."),
]
