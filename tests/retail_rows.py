"""Raw lines and folders that several test modules use."""

from __future__ import annotations

HEADER = "Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Customer ID;Country"
SEVEN_LINES = [
    "489434;85048;Ball;12;01.12.2009 07:45;6,95;13085;United Kingdom",
    "489434;85048;Ball;12;01.12.2009 07:45;6,95;13085;United Kingdom",
    "489435;79323P;Lights;6;02.12.2009 10:00;3,50;13086;France",
    "489436;22087;Lace;3;03.12.2009 11:00;2,95;;Germany",
    "C48949;79123;Return;-2;06.12.2009 16:00;3,00;13090;Portugal",
    "489500;85048;Ball;10;15.06.2010 08:00;6,95;13085;United Kingdom",
    "489501;22087;Lace;4;16.06.2010 09:00;2,95;13086;France",
]
SMALL_DATA = "/root/testdata/sf0.001"
