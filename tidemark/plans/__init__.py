"""Every operator as a runnable query over the supplied tables, with the equivalent SQL."""
