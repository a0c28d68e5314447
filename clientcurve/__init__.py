"""clientcurve: client-billing analytics on Spark.

Invoices, employee intervals and a CRM organisation snapshot in; an ABC
revenue curve, billing dates, activity status, group roll-ups, change flags
against the snapshot, an update outbox, run history and a recency / demand /
monetary profile out. Every step is a DataFrame -> DataFrame function made of
Spark built-ins.
"""

from .config import RunConfig
from .plans.billing_run import BillingRun

__all__ = ["BillingRun", "RunConfig"]
