"""Invoice Lake: procurement e-invoice analytics as Spark DataFrame functions."""
