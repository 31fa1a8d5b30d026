"""A week of source files and its known results."""

from __future__ import annotations

import datetime as dt
import os

TXN_HEADER = "transaction_id,account_id,transaction_date,amount,transaction_code,merchant_name,channel"
ACC_HEADER = (
    "account_id,customer_name,account_status,credit_limit,current_balance,open_date,"
    "billing_cycle_start,billing_cycle_end"
)
CODE_HEADER = "transaction_code,description,debit_credit_indicator,transaction_type,affects_balance"

# Five transactions per day, the balances of the three accounts per day, the code list, and
# the results they lead to.
# (day, account, amount, code, channel)
TRANSACTIONS = [
    (1, "ACC-001", "50.00", "PURCH01", "ONLINE"),
    (1, "ACC-002", "120.00", "PURCH01", "IN_STORE"),
    (1, "ACC-001", "200.00", "PAY01", "ONLINE"),
    (1, "ACC-ORPHAN", "75.00", "PURCH01", "IN_STORE"),
    (1, "ACC-001", "25.00", "PURCH01", "DRIVE_THRU"),
    (2, "ACC-001", "85.00", "PURCH01", "ONLINE"),
    (2, "ACC-003", "300.00", "PAY01", "ONLINE"),
    (2, "ACC-002", "45.00", "PURCH01", "IN_STORE"),
    (2, "ACC-ORPHAN", "60.00", "PURCH01", "IN_STORE"),
    (2, "ACC-001", "15.00", "FEE01", "DRIVE_THRU"),
    (3, "ACC-002", "500.00", "PAY01", "ONLINE"),
    (3, "ACC-003", "95.00", "PURCH01", "IN_STORE"),
    (3, "ACC-001", "30.00", "INT01", "ONLINE"),
    (3, "ACC-ORPHAN", "110.00", "PURCH01", "IN_STORE"),
    (3, "ACC-002", "40.00", "PURCH01", "DRIVE_THRU"),
    (4, "ACC-001", "175.00", "PURCH01", "ONLINE"),
    (4, "ACC-002", "65.00", "PURCH01", "IN_STORE"),
    (4, "ACC-003", "400.00", "PAY01", "ONLINE"),
    (4, "ACC-ORPHAN", "90.00", "PURCH01", "IN_STORE"),
    (4, "ACC-003", "20.00", "FEE01", "DRIVE_THRU"),
    (5, "ACC-003", "55.00", "PURCH01", "ONLINE"),
    (5, "ACC-001", "800.00", "PAY01", "ONLINE"),
    (5, "ACC-002", "35.00", "PURCH01", "IN_STORE"),
    (5, "ACC-ORPHAN", "45.00", "PURCH01", "IN_STORE"),
    (5, "ACC-001", "30.00", "INT01", "DRIVE_THRU"),
    (6, "ACC-001", "220.00", "PURCH01", "ONLINE"),
    (6, "ACC-003", "150.00", "PURCH01", "IN_STORE"),
    (6, "ACC-002", "600.00", "PAY01", "ONLINE"),
    (6, "ACC-ORPHAN", "80.00", "PURCH01", "IN_STORE"),
    (6, "ACC-002", "25.00", "INT01", "DRIVE_THRU"),
    (7, "ACC-002", "70.00", "PURCH01", "IN_STORE"),
    (7, "ACC-001", "1000.00", "PAY01", "ONLINE"),
    (7, "ACC-003", "130.00", "PURCH01", "IN_STORE"),
    (7, "ACC-ORPHAN", "55.00", "PURCH01", "IN_STORE"),
    (7, "ACC-003", "15.00", "FEE01", "DRIVE_THRU"),
]
BALANCES = {
    1: (1200, 850),
    2: (1150, 730, 2000),
    3: (1300, 630, 1950),
    4: (1250, 580, 1900),
    5: (1200, 530, 1850),
    6: (1350, 480, 1800),
    7: (1300, 430, 1750),
}
CODES = [
    "PURCH01,Purchase,DR,PURCHASE,true",
    "PAY01,Payment,CR,PAYMENT,true",
    "FEE01,Annual Fee,DR,FEE,true",
    "INT01,Interest Charge,DR,INTEREST,true",
]
# total, signed, purchase n and sum, payment n and sum, interest n and sum, online, in store,
# unresolvable n and amount
DAILY = {
    1: (3, -30, 2, 170, 1, -200, 0, 0, 2, 1, 1, 75),
    2: (3, -170, 2, 130, 1, -300, 0, 0, 2, 1, 1, 60),
    3: (3, -375, 1, 95, 1, -500, 1, 30, 2, 1, 1, 110),
    4: (3, -160, 2, 240, 1, -400, 0, 0, 2, 1, 1, 90),
    5: (3, -710, 2, 90, 1, -800, 0, 0, 2, 1, 1, 45),
    6: (3, -230, 2, 370, 1, -600, 0, 0, 2, 1, 1, 80),
    7: (3, -800, 2, 200, 1, -1000, 0, 0, 1, 2, 1, 55),
}
# purchases, mean purchase, payments, fees, interest, closing balance
WEEKLY = {
    "ACC-001": (4, 132.5, -2000, 0, 30, 1300),
    "ACC-002": (5, 67.0, -1100, 0, 0, 430),
    "ACC-003": (4, 107.5, -700, 0, 0, 1750),
}


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


def write_file(folder, name: str, header: str, lines: list[str]) -> None:
    with open(os.path.join(str(folder), name), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def transaction_lines(n: int) -> list[str]:
    lines = []
    rows = [row for row in TRANSACTIONS if row[0] == n]
    for i, (_, account, amount, code, channel) in enumerate(rows, 1):
        merchant = f"Shop {i}" if code == "PURCH01" else ""
        lines.append(f"TXN-{n:02d}-{i:03d},{account},{day(n)},{amount},{code},{merchant},{channel}")
    return lines


def account_line(i: int, balance, status="ACTIVE") -> str:
    return f"ACC-00{i},Customer {i},{status},5000.00,{balance},2020-01-15,2024-01-01,2024-01-31"


def account_lines(n: int) -> list[str]:
    return [account_line(i, f"{b}.00") for i, b in enumerate(BALANCES[n], 1)]


def write_day(folder, date, transactions: list[str], accounts: list[str]) -> None:
    write_file(folder, f"transactions_{date}.csv", TXN_HEADER, transactions)
    write_file(folder, f"accounts_{date}.csv", ACC_HEADER, accounts)


def write_codes(folder) -> None:
    write_file(folder, "transaction_codes.csv", CODE_HEADER, CODES)


def write_week(folder, days=range(1, 8)) -> None:
    write_codes(folder)
    for n in days:
        write_day(folder, day(n), transaction_lines(n), account_lines(n))
