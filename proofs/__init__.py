"""Every operator as a query over the driver tables, with its SQL twin."""
