"""Layer transforms, table builders, reports and the jobs that run them."""
