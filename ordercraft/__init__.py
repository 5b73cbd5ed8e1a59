"""Order analytics on Spark: order details, refill reminders and brand offers.

Everything is expressed as DataFrame plans. Entry points:

* ``ordercraft.operators.details.order_details`` - the order-details table;
* ``ordercraft.plans.jobs.run_staged`` / ``run_backfill`` - refill reminders and
  brand offers kept up to date from staged orders or as a backfill;
* ``ordercraft.sources.binding.Tables`` - the input tables of a run.
"""
